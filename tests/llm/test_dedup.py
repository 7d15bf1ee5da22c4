"""SimHash groups, substring dedup, embedding near-dedup and components against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import capfilters, simhash, substring
from strata.llm.capfilters import ProductCode, near_duplicates
from strata.llm.graph import components
from strata.llm.simhash import neighbour_steps, one_of_each_group, sig_of, simhash_groups
from strata.llm.substring import Words, remove_repeats
from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def near_copies(n=40):
    base = prose(1, 400).split(" ")
    out = []
    for k in range(n):
        words = list(base)
        words[(7 * k) % len(words)] = f"changed{k}"
        out.append((1000 + k, " ".join(words)))
    return out


def test_simhash_groups(spark, edge_docs, edge_rows, no_docs):
    rows = edge_rows + near_copies()
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(near_copies(), "doc_id long, text string"))
    fps = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    find = groups(len(fps), pairs)
    least = defaultdict(lambda: math.inf)
    for (d, _), g in zip(rows, find):
        least[g] = min(least[g], math.inf if d is None else d)
    want = Counter((d, f"{f:016x}", None if least[g] is math.inf else least[g]) for (d, _), f, g in zip(rows, fps, find))
    assert Counter(map(tuple, simhash_groups(docs).collect())) == want
    assert any(fps[i] != fps[j] for i, j in pairs)  # a link between different fingerprints
    assert simhash_groups(no_docs).count() == 0
    kept = one_of_each_group(edge_docs.unionByName(docs.where("doc_id >= 1000"), allowMissingColumns=True))
    assert kept.columns == edge_docs.columns
    ids = kept.select("doc_id", "text").collect()
    assert len(ids) == len(set(find))
    assert Counter(r["doc_id"] for r in ids) == Counter(None if v is math.inf else v for v in least.values())


def test_split_tiles(spark, monkeypatch):
    r = random.Random(3)
    base = r.getrandbits(64)
    values = {base} | {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)} | {r.getrandbits(64) for _ in range(100)}
    fps = [v - (1 << 64) if v >> 63 else v for v in values]
    want = {(min(a, b), max(a, b)) for a in fps for b in fps if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = simhash.links(frame, 2, tile_rows=7).collect()
    assert Counter(map(tuple, got)) == Counter(want)


@settings(max_examples=200, deadline=None)
@given(a=st.integers(0, 2**64 - 1), i=st.integers(0, 63), j=st.integers(0, 63))
def test_skipped_tiles_hold_no_link(a, i, j):
    b = a ^ (1 << i) ^ (1 << j)
    x, y = (int(sig_of(np.array([v], np.uint64).view(np.int64))[0]) for v in (a, b))
    assert x - y in neighbour_steps(2) or y - x in neighbour_steps(2)


def brute_repeats(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_remove_repeats(spark, edge_docs, edge_rows, no_docs):
    rows = [(d, t) for d, t in edge_rows if d != 5] + [(5, prose(5, 3000))]  # the brute force is slow
    docs = edge_docs.where("doc_id is null or doc_id <> 5").select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame([(5, prose(5, 3000), "en", "s")], "doc_id long, text string, lang string, source string"))
    want = Counter((d, *r) for (d, _), r in zip(rows, brute_repeats([t for _, t in rows], 35)))
    got = remove_repeats(docs, keep=("lang", "source"), buckets=5).collect()
    assert Counter(tuple(r)[:4] for r in got) == want
    assert {(r["lang"], r["source"]) for r in got} == {("en", "s")}
    digest = remove_repeats(docs, digest=True).collect()
    assert Counter(map(tuple, digest)) == Counter(
        {(d, n, k, hashlib.sha256(t.encode()).hexdigest()): c for (d, n, k, t), c in want.items()})
    as_is = {r["doc_id"]: r for r in remove_repeats(docs, as_is=True).where("n_removed = 0").collect()}
    assert all(as_is[d]["kept"] == (t or "") for d, t in rows if d in as_is and d not in (9, None))
    assert remove_repeats(no_docs).count() == 0


@settings(max_examples=25, deadline=None)
@given(data=st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=6))
def test_paths_cover_all_windows(data):
    texts = [" ".join(w).encode() for w in data]
    words = Words(texts)
    first, count, minimiser = words.paths(12)
    windows = [i for f, n in zip(first.tolist(), count.tolist()) for i in range(f, f + n)]
    before = words.before.tolist()
    assert sorted(windows) == [i for a, b in zip(before, before[1:]) for i in range(a, b - 11)]
    flat = [x for w in data for x in w]
    of = {}
    for f, n, m in zip(first.tolist(), count.tolist(), minimiser.tolist()):
        own = [tuple(flat[i : i + 12]) for i in range(f, f + n)]
        assert len(set(own)) == len(own)  # a path's windows differ
        for w in own:
            assert of.setdefault(w, m) == m  # equal windows have one minimiser


def test_repeats_inside_few_letters(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(0, 120))) for _ in range(25)] + ["a " * 90]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in remove_repeats(docs, window=12, buckets=3).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 12)


def test_components(spark):
    r = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100)] + [(200, 200 + k) for k in range(1, 30)] + [
        (r.randint(300, 400), r.randint(300, 400)) for _ in range(60)] + [(None, 3)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {x["node"]: x["component"] for x in components(edges).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    find = groups(401, real)
    assert got == {x: find[x] for p in real for x in p}
    assert components(edges.limit(0)).count() == 0


def vectors_with_copies(seed=6, n=150, d=24):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(1000 + k, (x[3] + 0.03 * r.normal(size=d)).astype(np.float32).tolist(), "x") for k in range(40)]  # near copies
    rows += [(2000 + k, x[5].tolist(), "x") for k in range(25)] + [(3000, (2 * x[7]).tolist(), "x")]  # copies, a multiple
    rows += [(4000, None, "x"), (4001, [0.0] * d, "x"), (4002, [float("nan")] * d, "x"), (4003, [float("inf")] + [1.0] * (d - 1), "x"),
             (4004, [None] + [1.0] * (d - 1), "x"), (4005, [], "x"), (4006, [1.0, 2.0], "x"), (4007, [1.0, 2.1], "x"),
             (None, x[9].tolist(), "x"), (8, x[8].tolist(), "x")]
    return rows


VECTOR_SCHEMA = "vec_id long, embedding array<float>, v string"


def valid(v):
    return v is not None and any(c != 0 for c in v if c is not None) and all(c is not None and math.isfinite(c) for c in v)


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "PART_ROWS", 16)  # so that the hot filters are split
    rows = vectors_with_copies()
    # rows that share an id are vectors of their own: two components meet in ids 5000 and 5001 but not in a row
    r = np.random.default_rng(8)
    a, b = r.normal(size=(2, 24))
    rows += [(5000, a.tolist(), "x"), (5000, b.tolist(), "x"), (4900, (a + 0.01).tolist(), "x"), (5001, (b + 0.01).tolist(), "x"), (5001, b.tolist(), "x")]
    # one id with a third of all rows: different vectors, among them copies and near copies of others
    rows += [(5100, v.tolist(), "x") for v in r.normal(size=(90, 24))]
    rows += [(5100, (np.array(rows[k][1]) * 1.5 + 0.01).tolist(), "x") for k in range(20)] + [(5100, rows[3][1], "x")] * 3
    frame = spark.createDataFrame(rows, VECTOR_SCHEMA).repartition(3)
    use = [(i, np.array(v, np.float64)) for i, v, _ in rows if i is not None and valid(v)]
    cos = lambda a, b: len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9
    pairs = [(a, b) for a in range(len(use)) for b in range(a) if cos(use[a][1], use[b][1])]
    links = Counter(x for p in pairs for x in p)
    order = sorted(range(len(use)), key=lambda k: use[k][0])
    place = {k: n for n, k in enumerate(order)}
    find = groups(len(use), [(place[a], place[b]) for a, b in pairs])
    want = Counter((use[k][0], links[k], use[order[find[place[k]]]][0]) for k in range(len(use)))
    want += Counter((i, 0, i) for i, v, _ in rows if i is None or not valid(v))
    got = near_duplicates(frame).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_shared_filters_at_the_threshold():
    r = np.random.default_rng(7)
    u = r.normal(size=(1500, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = r.normal(size=u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    code = ProductCode(64, 0.9)
    a = set(zip(*(x.tolist() for x in code.filters(u))))
    # the cap selects: hardly a vector exceeds no filter, and all filters that a vector exceeds are its own
    left, right = code.strengths(u[:200])
    beyond = [set(np.flatnonzero((left[k][:, None] + right[k] >= code.cap).ravel())) for k in range(200)]
    assert sum(len(b) < capfilters.LEAST for b in beyond) <= 8 and 30 < np.mean([len(b) for b in beyond]) < 150
    assert all(b == {f for r, f in a if r == k} for k, b in enumerate(beyond) if len(b) >= capfilters.LEAST)
    assert min(Counter(r for r, _ in a).values()) >= capfilters.LEAST and len({r for r, _ in a}) == len(u)
    for rho, least in ((0.9, 0.98), (0.95, 0.995)):
        b = set(zip(*(x.tolist() for x in code.filters(rho * u + math.sqrt(1 - rho**2) * w))))
        assert len({r for r, _ in a & b}) >= least * len(u)


@pytest.mark.parametrize("d", [1, 2, 3, 4, 7, 10])
def test_filters_of_few_dimensions(d):
    """Few directions differ there, so there are few filters; pairs at the threshold still meet."""
    r = np.random.default_rng(d)
    code = ProductCode(d, 0.9)
    u, w = r.normal(size=(2, 300, d))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    v = 0.9 * u + math.sqrt(0.19) * w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-30) if d > 1 else 3 * u
    a, b = (set(zip(*(x.tolist() for x in code.filters(x / np.linalg.norm(x, axis=1, keepdims=True))))) for x in (u, v))
    assert len({r for r, _ in a & b}) >= 0.95 * len(u) and max(Counter(r for r, _ in a).values()) <= 2 ** min(18, d + d % 2)


def test_substring_rejects_short_windows(no_docs):
    with pytest.raises(ValueError):
        remove_repeats(no_docs, window=substring.K - 1)
