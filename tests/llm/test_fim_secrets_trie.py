"""Fill-in-middle, secret scans and the prefix trie, against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import fim, secretscan
from strata.llm.prefixtrie import node_turns, ordered_turns, prefix_trie, rebuilt, with_starts

from .conftest import prose


# ---------------------------------------------------------------- fill-in-middle

def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fim_rows(rows):
    out = []
    for doc_id, text in rows:
        *known, output = brute_fim(doc_id, text)
        out.append((*known, sha(output), sha(text or "")))
    return sorted(out, key=repr)


def test_fim_of_edge_cases(spark, edge_docs, edge_rows):
    assert sorted(map(tuple, fim.digests(edge_docs).collect()), key=repr) == fim_rows(edge_rows)


def test_fim_texts(spark, edge_docs, edge_rows):
    got = sorted(map(tuple, fim.fill_in_middle(edge_docs).collect()), key=repr)
    assert got == sorted((brute_fim(d, t) for d, t in edge_rows), key=repr)
    assert {r[2] for r in got} == set(fim.FORMS)


def test_fim_of_marks_long_texts_and_copies(spark, monkeypatch):
    """Marks keep a text plain; broken marks don't mislead; texts of many pieces and blocks; a third of all rows one text."""
    rows = [(k, f"a<P>{k}") for k in range(5)] + [(k, f"<<P<S <M é<{'>' * k}P" + "<" * k) for k in range(10, 60)]
    rows += [(60 + k, "".join(random.Random(k).choice("aé< P>文Z1") for _ in range(40_000))) for k in range(6)]
    rows += [(70, "x" * 100_000), (71, "1" * 30_000)] + [(80, "the same text of copies")] * 40
    monkeypatch.setattr(fim, "BLOCK", 1 << 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, fim.digests(docs).collect()), key=repr) == fim_rows(rows)


def test_fim_of_no_rows(spark, no_docs):
    assert fim.digests(no_docs).collect() == [] and fim.fill_in_middle(no_docs).collect() == []


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_units_over_blocks(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    for seed in range(30):
        text = "".join(random.Random(seed).choice("ab  é文\n1Z") for _ in range(60))
        units, data = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL), text.encode()
        have = fim.Units(data)
        assert have.n == len(units)
        assert [have.place(k) for k in range(len(units) + 1)] == [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 100])
def test_restorer_takes_any_chunks(size):
    for doc_id in range(60):
        text = "ab< <S P> é" + str(doc_id)
        *_, form, _, _, output = brute_fim(doc_id, text)
        data, parts = output.encode(), defaultdict(bytes)
        restorer = fim.Restorer(form)
        for i in range(0, len(data), size):
            for rank, piece in restorer.feed(data[i:i + size]):
                parts[rank] += piece
        for rank, piece in restorer.feed(b"", last=True):
            parts[rank] += piece
        assert b"".join(parts[r] for r in sorted(parts)).decode() == text


def test_fim_moves_texts_once(spark, edge_docs):
    plan = fim.digests(edge_docs.coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("Sort [") == 2


# ---------------------------------------------------------------- secrets

KEYWORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(KEYWORD, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(a, b, secretscan.KINDS[k]) for a, k, b in sorted(found)]


def secret_text(r):
    def alnum(n, of="0123456789abcdef"):
        return "".join(r.choice(of) for _ in range(n))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    return r.choice([f'token = "{alnum(40)}"', f"password={alnum(18)}", f"AKIA{alnum(16, upper)}", alnum(32), f"Api_Key: {alnum(24, upper)}"])


@pytest.fixture(scope="module")
def secret_docs():
    r = random.Random(3)
    rows = []
    for k in range(400):
        words = prose(k, 60).split()
        words.insert(30, r.choice(["word.other@mail.example.com", "192.168.100.200", "understanding-everything", ""]))
        if k % 2:
            words.insert(20, secret_text(r))
        rows.append((k, " ".join(words)))
    return rows


TRICKY = ["AKIA1AKIA" + "Z" * 20, "AKIA" + "Z" * 13, "token=secret=abcdefghijkl", "token=password: abcdefghijklmnop", "ſecret=abcdefghijklmn", "toKen=abcdefghijklm",
          "API_KEY='0123456789abcdef0123'", "x" * 5000, "deadbeef" * 3, "é token: 0123456789ab", 'passwd"  =   "aaaaaaaaaaaa"', "secret:\nabcdefghijklmnop", "tokentoken=abcdefghijkl", ""]


def test_base_spans():
    for text in TRICKY:
        assert secretscan.base_spans(text) == brute_base(text), text


def test_every_candidate_is_covered_by_windows():
    for n in (12, 39, 40, 41, 100, 1000):
        text = "é" * 10 + "a" * n + " end of it"
        seen = set()
        for k, (window, lo, hi) in enumerate(secretscan.windows_of(text, 10, 10 + n)):
            assert len(window) == secretscan.WIDTH and window[lo:hi] == "a" * (hi - lo)
            first = 10 - secretscan.BEFORE + k * secretscan.STEP
            seen |= set(range(first + lo, first + hi))
        assert seen == set(range(10, 10 + n))


def test_candidates_meet_their_spans(secret_docs):
    for text in [t for _, t in secret_docs] + TRICKY:
        spans = secretscan.base_spans(text)
        for a, b, kind in secretscan.candidates(text, spans):
            want = [k for k in secretscan.KINDS if any(s[2] == k and s[0] < b and a < s[1] for s in spans)]
            assert kind == (want[0] if want else None)


def test_gradient():
    network = secretscan.Network(dtype=np.float64)
    ids = secretscan.encoded([w for t in ("token=abcdefghijklm and", "plain-words-only here") for w in secretscan.windows_of(t, 0, 12)])
    labels = np.array([1, 0])
    _, g = network.gradients(ids, labels)
    r = np.random.default_rng(0)
    for name, value in network.p.items():
        for _ in range(8):
            at = tuple(r.integers(0, s) for s in value.shape)
            if name == "e":
                at = (ids.ravel()[r.integers(0, ids.size)], at[1])
            old = value[at]
            value[at] = old + 1e-6
            up = network.gradients(ids, labels)[0]
            value[at] = old - 1e-6
            down = network.gradients(ids, labels)[0]
            value[at] = old
            assert abs((up - down) / 2e-6 - g[name][at]) < 1e-5


def findings_of(rows):
    out = []
    for _, text in rows:
        for a, b, kind in secretscan.candidates(text, secretscan.base_spans(text)):
            out += [(0 if kind is None else 1 + secretscan.KINDS.index(kind), *w) for w in secretscan.windows_of(text, a, b)]
    return out


@pytest.fixture(scope="module")
def network(secret_docs):
    return secretscan.fit(findings_of(secret_docs))


def test_network_on_unseen_texts(network):
    r = random.Random(77)
    rows = [(k, f"{prose(900 + k, 20)} {secret_text(r)} {prose(950 + k, 20)} notes.of@mail.example.com 10.20.130.240") for k in range(80)]
    found = findings_of(rows)
    yes = network.secret([f[1:] for f in found])
    labels = np.array([f[0] for f in found])
    assert yes[labels > 0].mean() >= 0.95 and yes[labels == 0].mean() <= 0.02


def test_network_adds_what_the_rules_miss(network):
    """Keys in upper-case hexadecimal digits stand in no rule."""
    r = random.Random(5)
    texts = [f"{prose(k, 15)} token is \"{''.join(r.choice('0123456789ABCDEF') for _ in range(40))}\" {prose(k + 50, 15)}" for k in range(40)]
    bases = [secretscan.base_spans(t) for t in texts]
    assert not any(bases)
    added = secretscan.added_spans(texts, bases, network)
    assert sum(bool(a) for a in added) >= 30
    for text, spans in zip(texts, added):
        for a, b, kind in spans:
            assert kind == secretscan.MODEL and len(text[a:b]) == 40


def test_thresholds_keep_the_recall(network, secret_docs):
    assert all(0.5 <= t <= 1 for t in network.thresholds)
    loose, strict = secretscan.Network(), secretscan.Network()
    found = sorted(set(findings_of(secret_docs)))
    ids, labels = secretscan.encoded([f[1:] for f in found]), np.array([f[0] for f in found])
    for n, recall in ((loose, 0.5), (strict, 1.0)):
        n.p = network.p
        n.calibrate(ids, labels, recall)
        for k, t in enumerate(n.thresholds):
            own = 1 - n.probabilities(ids[labels == k + 1])[:, 0]
            assert (own >= t).mean() >= recall or t == 0.5


def test_scan(spark, edge_docs, edge_rows, secret_docs, network):
    rows = edge_rows + secret_docs + [(1000 + k, t) for k, t in enumerate(TRICKY)]
    docs = edge_docs.select("doc_id", "text", "bucket").union(
        spark.createDataFrame([(*x, 1) for x in rows[len(edge_rows):]], "doc_id long, text string, bucket int"))
    got = secretscan.scan(docs, network).collect()
    want = []
    for doc_id, text in rows:
        base = brute_base(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        want.append((doc_id, *(sum(s[2] == k for s in base) for k in secretscan.KINDS), sha(listed), listed))
    key = repr
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted((w[:5] for w in want), key=key)
    bases = defaultdict(set)
    for w in want:
        bases[w[0]] |= set(filter(None, w[5].split(",")))
    for r in got:
        spans = [s for s in r["spans"].split(",") if s]
        assert {s for s in spans if not s.startswith("model")} <= bases[r["doc_id"]]
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_scan_without_findings_or_rows(spark, no_docs):
    docs = spark.createDataFrame([(1, "no such thing here"), (2, None)], "doc_id long, text string")
    empty = sha("")
    assert sorted(map(tuple, secretscan.scan(docs, secretscan.train_on(docs)).collect())) == [(1, 0, 0, 0, empty, ""), (2, 0, 0, 0, empty, "")]
    assert secretscan.scan(no_docs, secretscan.train_on(no_docs)).collect() == []


def test_training_takes_every_finding(spark, secret_docs, monkeypatch):
    """all distinct windows train or calibrate, in buckets, and how the rows lie makes no difference."""
    monkeypatch.setattr(secretscan, "BUCKET", 100)
    monkeypatch.setattr(secretscan, "LEAST_STEPS", 60)
    docs = spark.createDataFrame(secret_docs + [secret_docs[1]] * 50, "doc_id long, text string")
    want, seen = set(findings_of(secret_docs)), []
    by_bucket = secretscan._by_bucket
    monkeypatch.setattr(secretscan, "_by_bucket", lambda findings, *rest: seen.append(findings) or by_bucket(findings, *rest))
    network = secretscan.train_on(docs.repartition(7))
    assert len(seen) == secretscan.ROUNDS + 2
    taken = [[tuple(r)[:4] for r in rows.select("label", "window", "lo", "hi").collect()] for rows in (seen[0], seen[-1])]
    assert set(taken[0]) | set(taken[1]) == want and len(taken[0]) + len(taken[1]) == len(want)
    assert len({r["bucket"] for r in seen[0].select("bucket").distinct().collect()}) > 2
    again = secretscan.train_on(docs.coalesce(1))
    assert (again.flat() == network.flat()).all() and again.thresholds == network.thresholds


def test_whole_training_finds_unseen_secrets(spark, secret_docs):
    network = secretscan.train_on(spark.createDataFrame(secret_docs, "doc_id long, text string"))
    test_network_on_unseen_texts(network)
    assert all(0.5 <= t <= 1 for t in network.thresholds)


def test_training_sample_is_bounded(spark, secret_docs, monkeypatch):
    """A text that makes up most rows counts once; no more windows than asked for are taken."""
    docs = spark.createDataFrame(secret_docs + [secret_docs[1]] * 500, "doc_id long, text string")
    taken = []
    monkeypatch.setattr(secretscan, "fit", lambda findings: taken.extend(findings))
    secretscan.train_on(docs, sample_findings=60)
    assert len(taken) == len(set(taken)) == 120 and sum(f[0] > 0 for f in taken) == 60


# ---------------------------------------------------------------- prefix trie

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_trie(convs):
    """Nodes of {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    out = []
    for prefix, own in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        saved = sum((len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) for p in below if p)
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(prefix))
        out.append((own[0], len(prefix), members[prefix[:-1]][0] if prefix else None, len(own),
                    sum(1 for q in members if q and q[:-1] == prefix), len(leaves), saved, sha(ends)))
    return sorted(out, key=repr)


def brute_turns(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in convs.items()}


def brute_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_rows(seed, n=120, most=6):
    r = random.Random(seed)
    texts = ["", "hi", "hi there", "what is\tthat", "ok  ok", None]
    rows = []
    for c in r.sample(range(0, 30_000, 7) if seed % 2 else range(200), n):
        rows += [(c, t, r.choice(["user", "assistant", None]) if t else "user", r.choice(texts) if t % 2 else "hello you")
                 for t in range(r.randrange(1, most + 1))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "extra", 1) for x in rows], "conv_id long, turn long, role string, text string, node string, depth int").repartition(3)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_trie(spark, seed):
    rows = turn_rows(seed)
    rows += [(None, 0, "user", "lost"), (5000, None, "user", "first"), (5000, 0, "b", "tie"), (5000, 0, "a", "tie"), (5000, 0, "a", "tie"), (20, 9, None, None)]
    turns = ordered_turns(frame(spark, rows))
    convs = brute_turns(rows)
    got = prefix_trie(with_starts(turns)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(convs)
    got = prefix_trie(rebuilt(turns)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(brute_rebuilt(convs))


def test_trie_of_long_and_equal_conversations(spark):
    """Conversations over several bands that part late; equal ones and prefixes of others, over several shards."""
    long = [("u", f"turn {k}") for k in range(300)]
    convs = {c * 1500: long for c in range(8)}
    convs |= {100: long[:128], 101: long[:127] + [("u", "other")], 9000: long[:129], 9001: long[:256] + [("u", "x")] * 3, 3: long[1:200]}
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    got = prefix_trie(with_starts(ordered_turns(frame(spark, rows)))).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute_trie(convs)


def test_trie_of_no_rows(spark):
    none = frame(spark, [(1, 0, "a", "b")]).where("conv_id > 5")
    assert prefix_trie(rebuilt(ordered_turns(none))).collect() == []


def test_rebuilt_without_turns(spark):
    """A conversation may lose all its turns: its own are few and its base is absent."""
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "u", "one"), (lone, 1, "u", "two")]
    got = prefix_trie(rebuilt(ordered_turns(frame(spark, rows)))).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_node_turns(spark):
    rows = [(1, 0, "u", "a b"), (1, 1, "v", "c"), (2, 0, "u", "a b"), (2, 1, None, "d")]
    conversations = frame(spark, rows)
    got = node_turns(prefix_trie(with_starts(ordered_turns(conversations))), conversations).collect()
    assert {(r["conv_id"], r["depth"], r["role"], r["text"]) for r in got} == {
        (1, 0, None, None), (1, 1, "u", "a b"), (1, 2, "v", "c"), (2, 2, "", "d")}
