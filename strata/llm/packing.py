"""Packing (7): sum-of-squares online packing into windows of at most 2048 tokens.

A document's ids are cut into whole windows and one rest. The rest goes, online,
to the fill level that leaves the smallest sum of squared counts of partially
filled windows (Csirik et al., "On the sum-of-squares algorithm for bin
packing"): ``levels[h]`` counts the open windows holding h tokens; placing s
tokens at level h changes the sum by ``2 * (levels[h + s] - levels[h]) + 2``,
by ``2 * levels[s] + 1`` in a new window, and by ``1 - 2 * levels[h]`` where the
window fills up. At most ``OPEN`` windows are open: beyond, a rest that fits no
level is cut, its first part fills up a window of the most frequent level (that
takes most off the sum), and the remainder is placed by the same rule. Each task
packs its own stream of documents, so nothing is shuffled and memory is one Arrow
batch and the open windows. What is still open when the stream ends, ``OPEN``
windows at most, is laid end to end and cut into whole windows, and the last rest
is cut into powers of two (no padding): every id lies in one piece.

Defined results: null text is an empty text (its end id is still packed); null
ids, repeated rows and repeated ids are packed row by row; an empty table gives
no rows; other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD_BPE, table, utf8, vocabulary
from strata.llm.encode import WordEncoder, groups_of

WINDOW = 2048
OPEN = 64  # windows; on 10,000 documents under 2 % of the tokens are left to the end
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, ids binary")


class SumOfSquares:
    """Online packer of one stream; ``emit`` receives finished pieces.

    A piece is (document, start, ids, document's tokens).
    """

    def __init__(self, window: int, first_sequence: int, emit):
        self.window, self.sequence, self.emit = window, first_sequence, emit
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}  # fill level -> windows, each a list of pieces
        self.n_open = 0

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for a in range(0, whole, self.window):
            self._close([(doc, a, ids[a : a + self.window], len(ids))])
        if whole < len(ids):
            self._place((doc, whole, ids[whole:].copy(), len(ids)))

    def best_level(self, s: int) -> int | None:
        """Fill level (0: a new window) for s tokens; ties to the fullest; None if no window may be opened and none has room."""
        n, top = self.levels, self.window
        change = 2 * (n[s:] - n[: top - s + 1]) + 2
        change[n[: top - s + 1] == 0] = np.iinfo(np.int64).max  # no window at this level
        if n[top - s]:
            change[top - s] = 1 - 2 * n[top - s]
        change[0] = 2 * n[s] + 1 if self.n_open < OPEN else np.iinfo(np.int64).max
        best = int(len(change) - 1 - np.argmin(change[::-1]))
        return None if change[best] == np.iinfo(np.int64).max else best

    def _place(self, piece) -> None:
        while (h := self.best_level(len(piece[2]))) is None:
            doc, start, ids, total = piece
            h = self.window - int(np.argmax(self.levels[::-1]))  # the most frequent level, of equals the fullest
            room = self.window - h
            self._put((doc, start, ids[:room], total), h)
            piece = (doc, start + room, ids[room:], total)
        self._put(piece, h)

    def _put(self, piece, h: int) -> None:
        s = len(piece[2])
        if h:
            self.levels[h] -= 1
            pieces = self.open[h].pop()
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if h + s == self.window:
            self._close(pieces)
        else:
            self.levels[h + s] += 1
            self.open.setdefault(h + s, []).append(pieces)
            self.n_open += 1

    def _close(self, pieces) -> None:
        at = 0
        for p in pieces:
            self.emit(*p, self.sequence, at)
            at += len(p[2])
        self.sequence += 1

    def finish(self) -> None:
        """Lays the open windows end to end, fullest first, and cuts them anew."""
        rest = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        left = sum(len(p[2]) for p in rest)
        window, room = [], 0
        for doc, start, ids, total in rest:
            while len(ids):
                if not room:
                    room = size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                    left -= size
                part, ids = ids[:room], ids[room:]
                window.append((doc, start, part, total))
                start, room = start + len(part), room - len(part)
                if not room:
                    self._close(window)
                    window = []


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): where each run of ids lies, its crc and the ids (uint32, little-endian)."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])

    def run(batches):
        from pyspark import TaskContext

        rows: list[list] = [[] for _ in names]

        def emit(doc, start, ids, total, sequence, offset):
            data = ids.tobytes()
            values = (doc, start, len(ids), zlib.crc32(data), total, sequence, offset, data)
            for column, value in zip(rows, values):
                column.append(value)

        def flush():
            arrays = [pa.array(c, f.type) for c, f in zip(rows, schema)]
            for c in rows:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        encoder = _encoder(tokenizer)
        packer = SumOfSquares(window, TaskContext.get().partitionId() << 40, emit)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for part in groups_of(texts):
                ids, before = encoder.encode(texts[part])
                before = before.tolist()
                for doc, a, b in zip(docs[part], before, before[1:]):
                    packer.add(doc, np.append(ids[a:b], np.array([end_id], "<u4")))
                yield flush()
        packer.finish()
        yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECES)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder a Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE)).drop("ids")
