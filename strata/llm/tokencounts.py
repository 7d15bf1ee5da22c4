"""Token counts (9): each document is encoded once, whole, and its tokens are
attributed to sections by their places in the text.

Byte-level tokens tile the text's UTF-8 bytes, so the running sum of their
lengths gives each token's span; sections are spans of the same text, and the
interval join of the two is one binary search a token, inside the task that
holds the document: nothing is shuffled. A token that crosses a boundary is
allocated by an explicit rule:

* ``first``: to the section that holds its first byte;
* ``majority``: to the section that holds most of its bytes, ties to the earlier;
* ``split``: to every section it touches, in proportion to its bytes.

Where given sections overlap, the text is the part of the section that starts
first (of equal starts the shorter), so no byte counts twice; the result still
names each section by its given span. A token's bytes outside every section count
nowhere.

Defined results: null or empty text has one empty section with no tokens; given
sections that are null, have a null bound or end before they start are left out;
bounds beyond the text are taken back to it;
repeated rows are counted row by row; null ids stay; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import BYTE_BPE, table, utf8, vocabulary
from strata.llm.encode import groups_of
from strata.llm.tokenfiles import encoder_of

RULES = ("first", "majority", "split")
SCHEMA = ("doc_id bigint, section bigint, start bigint, end bigint, n_tokens double, "
          "n_crossing bigint, doc_tokens bigint")


def line_spans(text: bytes) -> np.ndarray:
    """Byte spans of a text's lines, each with its line end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    if not len(text):
        ends = np.zeros(1, np.int64)
    return np.column_stack([np.concatenate([[0], ends[:-1]]), ends])


def apart(spans: np.ndarray) -> np.ndarray:
    """Spans in order of start and end, each without what earlier ones hold."""
    if not len(spans):
        return spans
    before = np.concatenate([[0], np.maximum.accumulate(spans[:, 1])[:-1]])
    start = np.maximum(spans[:, 0], before)
    return np.column_stack([start, np.maximum(start, spans[:, 1])])


def share(tokens: np.ndarray, spans: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, crossing tokens that touch it).

    ``tokens``: boundaries of the text's tokens, 0 first. ``spans``: sorted
    byte spans that do not overlap.
    """
    first, end = tokens[:-1], tokens[1:]
    counts, crossing = np.zeros(len(spans)), np.zeros(len(spans), np.int64)
    lo = np.searchsorted(spans[:, 1], first, "right")  # first section that ends after the token's start
    hi = np.searchsorted(spans[:, 0], end, "left") - 1  # last that starts before the token's end
    inside = lo < len(spans)
    whole = inside & (lo == hi)
    whole[whole] &= (spans[lo[whole], 0] <= first[whole]) & (end[whole] <= spans[lo[whole], 1])
    counts += np.bincount(lo[whole], minlength=len(spans))
    for t in np.flatnonzero(inside & ~whole & (lo <= hi)):
        touched = np.arange(lo[t], hi[t] + 1)
        held = np.minimum(spans[touched, 1], end[t]) - np.maximum(spans[touched, 0], first[t])
        touched, held = touched[held > 0], held[held > 0]
        if not len(touched):
            continue
        crossing[touched] += 1
        if rule == "split":
            counts[touched] += held / (end[t] - first[t])
        elif rule == "majority":
            counts[touched[np.argmax(held)]] += 1
        elif spans[touched[0], 0] <= first[t]:
            counts[touched[0]] += 1
    return counts, crossing


def token_counts(docs: DataFrame, tokenizer: str, sections: str | None = None, rule: str = "first") -> DataFrame:
    """One row per document and section: its span in code points and its tokens.

    ``sections`` names a column of type array<struct<start,end>> (code points,
    end excluded); None: the text's lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if sections:
        known = F.filter(sections, lambda s: F.coalesce(s["start"] <= s["end"], F.lit(False)))
        spans = F.transform(known, lambda s: F.array(s["start"].cast("bigint"), s["end"].cast("bigint")))
        columns.append(F.sort_array(spans).alias("spans"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            given = batch.column(2).to_pylist() if sections else None
            for part in groups_of(texts):
                ids, before = encoder.encode(texts[part])
                sizes = encoder.piece_bytes[ids]
                out: list[list] = [[] for _ in names]
                for i, a, b in zip(range(part.start, part.stop), before.tolist(), before[1:].tolist()):
                    text, tokens = texts[i], np.concatenate([[0], np.cumsum(sizes[a:b])])
                    # code points before each byte, and the bytes where code points begin
                    chars = None
                    if not text.isascii():
                        chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
                    if given is None:
                        spans = line_spans(text)
                        shown = spans if chars is None else chars[spans]
                    else:
                        shown = np.array(given[i] or [], np.int64).reshape(-1, 2)
                        n = len(text) if chars is None else int(chars[-1])
                        shown = np.clip(shown, 0, n)
                        spans = apart(shown)
                        if chars is not None:
                            leads = np.append(np.flatnonzero(np.diff(chars)), len(text))
                            spans = leads[spans]
                    counts, crossing = share(tokens, spans, rule)
                    k = len(spans)
                    values = ([doc_ids[i]] * k, range(k), shown[:, 0].tolist(), shown[:, 1].tolist(),
                              counts.tolist(), crossing.tolist(), [b - a] * k)
                    for column, value in zip(out, values):
                        column.extend(value)
                types = [pa.float64() if n == "n_tokens" else pa.int64() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return docs.select(*columns).mapInArrow(run, SCHEMA)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents: tokens by the ``first`` rule, which gives whole numbers."""
    counts = token_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))
    return counts.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
