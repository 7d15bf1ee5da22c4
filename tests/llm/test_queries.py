"""The registered queries over whole small tables: against SQL, else against brute force."""

import hashlib
import html
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from strata.llm.common import BYTE_BPE, WORD_BPE, vocabulary
from strata.llm.encode import load_tokenizer
from strata.llm.oracle import ORACLE
from strata.llm.queries import QUERIES

from .test_dedup import brute_fingerprint, brute_repeats, groups
from .test_fim_secrets_trie import brute_base, sha

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def collected(spark, name):
    return E.queries()[name](spark, SF).collect()


def test_all_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(ORACLE[name])
    names, want = rel.columns, rel.fetchall()
    got = E.queries()[name](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_op2(spark):
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in collected(spark, "op2_host_paths")}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:  # the tables' pages have one shape
        body = re.search(r"<article>(.*?)(</article>|$)", p["html"], re.DOTALL)[1]
        lines = html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", "\n", body))).split("\n")
        want = "\n".join(x for x in (" ".join(y.split()) for y in lines) if x)
        assert got[p["page_id"]] == (want, len(want))


def test_op3(spark, docs):
    rows = collected(spark, "op3_language")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == {d for d, _ in docs} and len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.93 * len(held)


def test_op4_and_op6_and_op9(spark, docs):
    t = load_tokenizer(vocabulary(BYTE_BPE))
    ids = {d: t.encode(x or "", add_special_tokens=False).ids for d, x in docs}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert {r["doc_id"]: tuple(r)[1:] for r in collected(spark, "op4_word_table")} == {
        d: (len(i), sha(np.array(i, "<u4").tobytes()), sha(t.decode(i, skip_special_tokens=False).encode())) for d, i in ids.items()}
    want, start = {}, 0
    for d, i in sorted(ids.items()):
        want[d] = (start, len(i) + 1, zlib.crc32(np.array([*i, 2], "<u4").tobytes()))
        start += len(i) + 1
    assert {r["doc_id"]: tuple(r)[1:] for r in collected(spark, "op6_token_files")} == want
    totals = defaultdict(int)
    for r in collected(spark, "op9_token_counts"):
        totals[r["doc_id"]] += r["n_tokens"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert totals == {d: len(i) for d, i in ids.items()}


def test_op5(spark, docs):
    fps = [brute_fingerprint(x) for _, x in docs]
    find = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    want = {d: (f"{f:016x}", docs[g][0]) for (d, _), f, g in zip(docs, fps, find)}  # ids ascend, so g is the smallest
    assert {r["doc_id"]: tuple(r)[1:] for r in collected(spark, "op5_simhash")} == want


def test_op12(spark, docs):
    """Base spans against the contract's patterns; whatever the network adds touches none of them."""
    got = {r["doc_id"]: r for r in collected(spark, "op12_secrets")}
    assert len(got) == len(docs)
    for d, x in docs:
        base = brute_base(x or "")
        listed = [f"{k}:{a}:{b}" for a, b, k in base]
        assert [got[d][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
        assert got[d]["base_sha256"] == sha(",".join(listed))
        spans = [s for s in got[d]["spans"].split(",") if s]
        assert [s for s in spans if not s.startswith("model")] == listed
        for s in spans:
            kind, a, b = s.split(":")
            assert kind != "model" or not any(int(a) < e and s < int(b) for s, e, _ in base)


def check_pieces(rows, docs):
    t = load_tokenizer(vocabulary(WORD_BPE))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == {d for d, _ in docs}
    for d, x in docs:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048 and ends[-1].bit_count() == 1


def test_op7(spark, docs):
    check_pieces(collected(spark, "op7_packing"), docs)


def test_pipeline(spark, docs):
    import corpus_pipeline as pipeline

    first = pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    left = sorted((r["doc_id"], r["text"]) for r in first.select("doc_id", "text").collect())
    assert len(left) >= 0.98 * len(docs) and set(left) <= set(docs)
    fps = [brute_fingerprint(x) for _, x in left]
    find = groups(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    left = [x for k, x in enumerate(left) if find[k] == k]
    cut = brute_repeats([x for _, x in left], 35)
    left = [(d, x if not n else k) for (d, x), (words, n, k) in zip(left, cut) if n < words or not words]
    check_pieces(collected(spark, "pipeline"), left)
