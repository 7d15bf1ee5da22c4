"""Fill-in-middle transformation (11) by secondary-sort assembly.

A task cuts each text into prefix, middle and suffix at unit boundaries and emits
them as chunks of whole units (a run of letters beyond ``CHUNK`` bytes is cut
inside), keyed by document and place in the output. One shuffle deals them out by
document and sorts them by place (``repartition`` and ``sortWithinPartitions``, the
DataFrame form of repartitionAndSortWithinPartitions); the sorted pieces stream
into incremental digests, and no task holds an output. For the restoration the
streamed output is read again from its form and marks alone: each chunk learns its
segment, and a second sort inside the same partitions puts prefix, middle and
suffix in the text's order, so the text crosses the network once.

Memory: a text's row in the task that cuts it (units are found a block at a time),
a batch of chunks afterwards. Rows of the same id and text in a batch are sent
once with their count, and a document's key holds the number of the partition that
sent it, so a row that makes up a third of the table meets in no single task; keys
depend on nothing but rows and partition, so a task that runs again sends the same.

Defined results: null text is empty, and plain; repeated rows give repeated
results; a null id counts as no digits in the hash; an empty table gives no rows;
other columns are left out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, utf8

P, S, M = MARKS = (b"<P>", b"<S>", b"<M>")
FORMS = ("plain", "psm", "spm")
#: The marks of each form, in the order of its output; and the place of a mark's segment in the text.
ORDER = {"plain": (), "psm": (P, S, M), "spm": (S, P, M)}
RANK = {P: 0, M: 1, S: 2}

CHUNK = 1 << 13  # bytes of a piece
BLOCK = 1 << 20  # bytes in which units are counted at a time

#: 0 inside a character, 1 a letter, 2 any other character's first byte.
KIND = np.full(256, 2, np.uint8)
KIND[0x80:0xC0] = 0
KIND[65:91] = KIND[97:123] = 1


@dataclass(frozen=True)
class Rule:
    """How documents are drawn: h3 % 100 >= rate stays plain, h4 % 100 < spm is suffix first."""

    salt: str = "1"
    rate: int = 90
    spm: int = 20


def unit_starts(text: bytes, a: int, b: int) -> np.ndarray:
    """Places in ``text[a:b]`` at which a unit ([A-Za-z]+ or any other character) begins."""
    kind = KIND[np.frombuffer(text, np.uint8, b - a, a)]
    before = np.concatenate([[KIND[text[a - 1]] if a else 0], kind[:-1]])
    return a + np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))


class Units:
    """A text's units, counted a block at a time."""

    def __init__(self, text: bytes):
        self.text = text
        self.counts, self.only = [], None
        for i in range(0, len(text), BLOCK):
            starts = unit_starts(text, i, min(i + BLOCK, len(text)))
            self.counts.append(len(starts))
            self.only = starts if len(text) <= BLOCK else None
        self.n = sum(self.counts)

    def place(self, k: int) -> int:
        """Where unit k begins; the text's end for k = n."""
        if k == self.n:
            return len(self.text)
        if self.only is not None:
            return int(self.only[k])
        for i, count in enumerate(self.counts):
            if k < count:
                return int(unit_starts(self.text, i * BLOCK, min((i + 1) * BLOCK, len(self.text)))[k])
            k -= count
        raise IndexError(k)


def chunks(text: bytes, a: int, b: int) -> Iterator[bytes]:
    """``text[a:b]`` in pieces of whole units; at least one, maybe empty."""
    while b - a > CHUNK:
        starts = unit_starts(text, a, a + CHUNK + 1)
        end = int(starts[-1]) if len(starts) and starts[-1] > a else a + CHUNK
        yield text[a:end]
        a = end
    yield text[a:b]


_HEAD = "<?qqBqqq"  # has an id, id, n, form, prefix and middle characters, copies


def cut(doc_id: int | None, text: bytes, rule: Rule) -> tuple[int, str, int, int]:
    """(units, form, end of the prefix, end of the middle), in bytes of the text."""
    digest = hashlib.sha256(f"{rule.salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    units = Units(text)
    n = units.n
    if not text or h3 % 100 >= rule.rate or any(m in text for m in MARKS):
        return n, "plain", 0, 0
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < rule.spm else "psm", units.place(lo), units.place(hi)


def _chars(text: bytes, a: int, b: int) -> int:
    return int(np.count_nonzero(KIND[np.frombuffer(text, np.uint8, b - a, a)]))


def pieces_of(doc_id: int | None, text: bytes, rule: Rule, copies: int = 1) -> Iterator[tuple[int, bytes]]:
    """(place, payload): the head at -1, then the output's chunks; a segment's first one begins with its mark."""
    n, form, a, b = cut(doc_id, text, rule)
    known = (-1, -1) if form == "plain" else (_chars(text, 0, a), _chars(text, a, b))
    yield -1, struct.pack(_HEAD, doc_id is not None, doc_id or 0, n, FORMS.index(form), *known, copies)
    spans = {P: (0, a), M: (a, b), S: (b, len(text))}
    place = 0
    for mark in ORDER[form] or (b"",):
        for chunk in chunks(text, *spans.get(mark, (0, len(text)))):
            yield place, mark + chunk
            mark, place = b"", place + 1


class Restorer:
    """Tells the segments of a streamed output apart by its form and marks; chunks may cut a mark."""

    def __init__(self, form: str):
        self.waiting, self.rank, self.kept = list(ORDER[form]), 0, b""

    def feed(self, data: bytes, last: bool = False) -> Iterator[tuple[int, bytes]]:
        data, self.kept = self.kept + data, b""
        while self.waiting:
            at = data.find(self.waiting[0])
            if at < 0:
                if not last:
                    data, self.kept = data[:-2], data[-2:]
                break
            if at:
                yield self.rank, data[:at]
            self.rank, data = RANK[self.waiting.pop(0)], data[at + 3:]
        if data:
            yield self.rank, data


_PIECES = "key binary, place bigint, payload binary"


def _batches(rows: Iterator[tuple], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    keys, places, payloads, n = [], [], [], 0

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(places, pa.int64()), pa.array(payloads, pa.binary())],
            names=["key", "place", "payload"])

    for key, place, payload in rows:
        keys.append(key)
        places.append(place)
        payloads.append(payload)
        n += len(payload) + 64
        if n >= size:
            yield made()
            keys, places, payloads, n = [], [], [], 0
    yield made()


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def pieces(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every document's output as (key, place, payload), dealt out by document and sorted by place."""

    def run(batches):
        part = TaskContext.get().partitionId()

        def rows():
            for batch in batches:
                copies: dict[tuple, list] = {}
                for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                    same = doc_id, hashlib.blake2b(text, digest_size=16).digest()
                    copies.setdefault(same, [0, text])[0] += 1
                for (doc_id, digest), (count, text) in copies.items():
                    key = hashlib.blake2b(f"{part}:{doc_id}:".encode() + digest, digest_size=16).digest()
                    for place, payload in pieces_of(doc_id, text, rule, count):
                        yield key, place, payload

        yield from _batches(rows())

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, _PIECES).repartition("key").sortWithinPartitions("key", "place")


def _documents(rows: Iterator[tuple]) -> Iterator[tuple[bytes, list, Iterator[bytes]]]:
    """(key, heads, payloads) of each document; a piece that several batches sent comes once."""
    row = next(rows, None)
    while row is not None:
        key, heads = row[0], []
        while row is not None and row[0] == key and row[1] < 0:
            heads.append(row[2])
            row = next(rows, None)

        def payloads():
            nonlocal row
            before = None
            while row is not None and row[0] == key:
                if row[1] != before:
                    before = row[1]
                    yield row[2]
                row = next(rows, None)

        rest = payloads()
        yield key, heads, rest
        for _ in rest:
            pass


def _merged(heads: list[bytes]) -> tuple:
    """The head of a document, with all its copies."""
    first = struct.unpack(_HEAD, heads[0])
    return *first[:-1], sum(struct.unpack(_HEAD, h)[-1] for h in heads)


def restorable(outputs: DataFrame) -> DataFrame:
    """The outputs' chunks in the order of their texts: (key, place, payload), the head followed by the output's digest.

    ``outputs`` as ``pieces`` gives them; segments are told by form and marks.
    """

    def run(batches):
        def rows():
            for key, heads, payloads in _documents(_rows(batches)):
                head = _merged(heads)
                digest, restorer, place = hashlib.sha256(), Restorer(FORMS[head[3]]), 0
                for payload in payloads:
                    digest.update(payload)
                    for rank, data in restorer.feed(payload):
                        yield key, rank << 48 | place, data
                        place += 1
                for rank, data in restorer.feed(b"", last=True):
                    yield key, rank << 48 | place, data
                    place += 1
                yield key, -1, struct.pack(_HEAD, *head) + digest.digest()

        yield from _batches(rows())

    return outputs.mapInArrow(run, _PIECES).sortWithinPartitions("key", "place")


def _columns(head: tuple) -> tuple:
    known, doc_id, n, form, prefix, middle, copies = head
    shown = (None, None) if FORMS[form] == "plain" else (prefix, middle)
    return doc_id if known else None, n, FORMS[form], *shown


_TEXTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
_DIGESTS = _TEXTS.replace("output string", "output_sha256 string, restored_sha256 string")


def _results(frame: DataFrame, schema: str, of) -> DataFrame:
    """``of``(heads, payloads) for each document, as often as it has copies."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if c.endswith("bigint") else pa.string() for c in schema.split(", ")]

    def run(batches):
        out, n = [], 0

        def made():
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for _, heads, payloads in _documents(_rows(batches)):
            row, copies = of(heads, payloads)
            for _ in range(copies):
                out.append(row)
                n += 256 + len(row[5] or "")
                if n >= 4 << 20:
                    yield made()
                    out, n = [], 0
        yield made()

    return frame.mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every document with its form and whole output text."""

    def of(heads, payloads):
        head = _merged(heads)
        return (*_columns(head), b"".join(payloads).decode()), head[-1]

    return _results(pieces(docs, rule), _TEXTS, of)


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Every document with its form and the SHA-256 of its output and of the text restored from that."""

    def of(heads, payloads):
        head = struct.unpack(_HEAD, heads[0][:struct.calcsize(_HEAD)])
        restored = hashlib.sha256()
        for data in payloads:
            restored.update(data)
        return (*_columns(head), heads[0][struct.calcsize(_HEAD):].hex(), restored.hexdigest()), head[-1]

    return _results(restorable(pieces(docs, rule)), _DIGESTS, of)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
