"""Prefix trie of conversations (13): vertical bitmaps per shard, merged by prefix id.

A shard holds a range of conversation ids. Its index maps (position, turn) to the
bitset of the shard's conversations that have this turn there. A node is a bitset
too; its children come depth first, by meeting it with the postings of the next
position: the lowest conversation left names the posting, and the meeting is the
child. Population counts give the members, the bitsets of lengths the end lists.

A node is known across shards by its prefix id, 128 bits of a SHA-256 chain over
the turns' digests; its shards' counts are added, and its end lists hashed in the
order of the shards. Sums over subtrees need no rounds and no list of ancestors:
every node belongs to its smallest member, so a conversation m owns its nodes from
some depth f(m) on. The saved tokens of a subtree are, over its members, the words
that m shares before f(m), and its leaves are the members that own a childless
node. A second walk of the shards, now told f(m), adds both up. The number of Spark
jobs doesn't depend on the depth.

Memory: a task holds one band of ``BAND`` positions of one shard, and goes on to
the next band with the nodes that are still open. So a conversation of any length
is streamed, though by one task, since each prefix needs the one before. A hot turn
or a hot conversation text costs one row a shard.

Defined results: turns in order of ``turn``, null first, ties by the digest of role
and text; null role or text is empty; repeated rows are repeated turns; rows of a
null conv_id are left out; an empty table has no nodes; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written

SHARD = 960  # conversation ids a shard, a multiple of the rebuild's 20
BAND = 128  # positions held at a time
ROOT = bytes(16)
WORD = "[^\\x20\\x09-\\x0D]+"

_FOUND = ("shard bigint, depth bigint, node binary, parent binary, conv_id bigint, n_convs bigint, "
          "words bigint, path bigint, ends string")
_SUMS = "node binary, n_leaves bigint, saved_tokens bigint"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position from 1, digest, words) of every turn; role and text stay where they are."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(place).cast("bigint").alias("position"), "digest", "words")


_START = "named_struct('position', 0L, 'digest', cast(null as binary), 'words', 0L)"


def with_starts(ordered: DataFrame) -> DataFrame:
    """Adds each conversation's start, at position 0."""
    own = "named_struct('position', position, 'digest', digest, 'words', words)"
    return ordered.selectExpr("conv_id", f"inline(if(position = 1, array({_START}, {own}), array({own})))")


def rebuilt(ordered: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """Conversation c as the first h turns of c - c % group, then its own after its first h; h = crc32(c) % heads."""
    base = F.col("conv_id") - F.col("conv_id") % F.lit(group)
    rows = ordered.select("*", base.alias("base"),
                          (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    first = (rows.where(f"conv_id = base AND position < {heads}").groupBy("base")
             .agg(F.sort_array(F.collect_list(F.struct("position", "digest", "words"))).alias("first")))  # under `heads`
    rows = rows.join(first, "base", "left")
    front = "coalesce(slice(first, 1, cast(h as int)), array())"
    own = f"named_struct('position', position - h + size({front}), 'digest', digest, 'words', words)"
    return rows.selectExpr(
        "conv_id", f"inline(concat(if(position = 1, concat(array({_START}), {front}), array()), "
        f"if(position > h, array({own}), array())))")


def _bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


class _Shard:
    """The open nodes of one shard, band by band. Conversations are numbered by ascending id."""

    def __init__(self, number: int, starts: list, emit, second: bool):
        self.number, self.emit, self.second = number, emit, second
        self.convs = [r[0] for r in starts]
        self.at = {c: i for i, c in enumerate(self.convs)}
        self.done: dict[int, int] = {}  # length -> conversations of that length
        self.taken: dict[int, int] = {}  # depth -> conversations that own their nodes from there on
        self.leaf, self.shared = 0, [r[6] for r in starts]
        for i, r in enumerate(starts):
            self.done[r[4]] = self.done.get(r[4], 0) | 1 << i
            if second:
                self.taken[r[5]] = self.taken.get(r[5], 0) | 1 << i
                self.leaf |= int(r[7]) << i
        everyone = (1 << len(starts)) - 1
        self.open = [(everyone, self._add(everyone, everyone, 0, ROOT, None, 0, 0), 0, ROOT, 0)]

    def _add(self, members: int, late: int, depth: int, node: bytes, parent: bytes | None, words: int, path: int) -> int:
        """Writes the node; returns its members that do not own it. ``path``: words up to and with its own."""
        if self.second:
            late &= ~self.taken.get(depth, 0)
            leaves = (members & self.leaf).bit_count()
            saved = sum(self.shared[m] for m in _bits(late)) - late.bit_count() * (path - words)
            if leaves or saved:
                self.emit((node, leaves, saved))
            return late
        ends = ",".join(str(self.convs[m]) for m in _bits(members & self.done.get(depth, 0))) or None
        least = self.convs[(members & -members).bit_length() - 1]
        self.emit((self.number, depth, node, parent, least, members.bit_count(), words, path, ends))
        return 0

    def walk(self, band: int, rows: list) -> None:
        """Depth first through the band's positions, ``rows`` sorted by conversation and position."""
        begin, end = band * BAND, (band + 1) * BAND
        turns: dict[int, list] = {}
        postings: dict[tuple, int] = {}  # ~i for a single conversation i
        for conv, position, digest, words, *_ in rows:
            i = self.at[conv]
            turns.setdefault(i, []).append((digest, words))
            key = position, digest
            old = postings.get(key)
            if old is None:
                postings[key] = ~i
            else:
                postings[key] = (old if old >= 0 else 1 << ~old) | 1 << i
        stack, self.open = self.open, []
        while stack:
            members, late, depth, node, path = stack.pop()
            live = members & ~self.done.get(depth, 0)
            if depth == end:
                if live:
                    self.open.append((members, late, depth, node, path))
                continue
            while live:
                low = live & -live
                digest, words = turns[low.bit_length() - 1][depth - begin]
                posting = postings[depth + 1, digest]
                child = low if posting < 0 else live & posting
                live ^= child
                name = hashlib.sha256(node + digest).digest()[:16]
                own = self._add(child, late & child, depth + 1, name, node, words, path + words)
                stack.append((child, own, depth + 1, name, path + words))


def _walked(turns: DataFrame, starts: DataFrame, second: bool) -> DataFrame:
    """Every shard's nodes, or with ``second`` their sums. Starts come first in a shard."""
    shard = F.expr(f"conv_id div {SHARD}")
    rows = turns.where("position > 0").select(
        shard.alias("shard"), F.expr(f"(position - 1) div {BAND}").alias("band"), "conv_id", "position", "digest", "words",
        *[F.lit(None).cast(t).alias(c) for c, t in (("length", "bigint"), ("owns", "bigint"), ("shared", "bigint"), ("leaf", "boolean"))])
    heads = starts.select(shard, F.lit(-1).cast("bigint"), "conv_id", F.lit(0).cast("bigint"), F.lit(None).cast("binary"),
                          F.lit(0).cast("bigint"), "length", "owns", "shared", "leaf")
    names = [c.split()[0] for c in (_SUMS if second else _FOUND).split(", ")]
    types = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds = [types[c.split()[1]] for c in (_SUMS if second else _FOUND).split(", ")]

    def run(batches):
        out: list[tuple] = []

        def flat():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def made():
            columns = list(zip(*out)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        one = None
        for (number, band), some in groupby(flat(), key=lambda r: r[:2]):
            some = [r[2:] for r in some]
            if band < 0:
                one = _Shard(number, some, out.append, second)
            else:
                one.walk(band, some)
            if len(out) >= 5000:
                yield made()
        yield made()

    return (rows.union(heads).repartition("shard").sortWithinPartitions("shard", "band", "conv_id", "position")
            .mapInArrow(run, _SUMS if second else _FOUND))


def _hashed_ends(found: DataFrame) -> DataFrame:
    """(node, ends_sha256): a node's lists hashed as they come, in the order of the shards."""

    def run(batches):
        node, digest = None, None
        for batch in batches:
            names, sums = [], []
            for n, ends in zip(*(c.to_pylist() for c in batch.columns[::2])):
                if n != node:
                    if node is not None:
                        names.append(node)
                        sums.append(digest.hexdigest())
                    node, digest = n, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    return (found.where("ends IS NOT NULL").select("node", "shard", "ends").repartition("node")
            .sortWithinPartitions("node", "shard").mapInArrow(run, "node binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of ``turns`` (as ``with_starts`` or ``rebuilt`` give them): one row a node.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 as the contract has them; node and parent are prefix ids.
    """
    turns = written(turns.select("conv_id", "position", "digest", "words"), "trie-turns")
    lengths = turns.groupBy("conv_id").agg(F.max("position").alias("length"), F.sum("words").alias("total"))
    blank = [F.lit(None).cast(t).alias(c) for c, t in (("owns", "bigint"), ("shared", "bigint"), ("leaf", "boolean"))]
    found = written(_walked(turns, lengths.select("conv_id", "length", *blank), second=False), "trie-found")
    nodes = written(found.groupBy("depth", "node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("words").alias("words"), F.max("path").alias("path")), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "trie-nodes")
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("owns"), F.min_by(F.col("path") - F.col("words"), "depth").alias("shared"),
        (F.max_by("n_children", "depth") == 0).alias("leaf"))
    starts = lengths.join(owned, "conv_id", "left").select(
        "conv_id", "length", F.expr("coalesce(owns, length + 1)").alias("owns"),
        F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(False)).alias("leaf"))
    sums = _walked(turns, starts, second=True).groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    none = hashlib.sha256(b"").hexdigest()
    whole = nodes.join(sums, "node").join(_hashed_ends(found), "node", "left")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # a node with very many children is a hot key: this join comes last, on scans and one exchange, so that AQE can split it
    return whole.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "node", "parent")


def node_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie's nodes with the role and text of their last turn (null at the root), for tries that aren't rebuilt."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.unhex(F.sha2(whole, 256)))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.row_number().over(place).cast("bigint").alias("depth"),
        role.alias("role"), text.alias("text"))
    return nodes.join(turns, ["conv_id", "depth"], "left")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = rebuilt(ordered_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(turns).drop("node", "parent")
