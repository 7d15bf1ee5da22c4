"""Whole-text BPE encoding inside a task: each distinct chunk once.

Pre-tokens of the two kinds of tokenizer here never run from a visible
character into the white space after it, so a text may be cut wherever ASCII
white space follows a visible character: the ids of the chunks joined are the
ids of the text. ``cut_chunks`` finds all chunks of many texts with numpy,
``ChunkEncoder`` encodes each distinct one with the ``tokenizers`` library and
looks the rest up. Texts in which such a cut is not certain (white space
outside ASCII, a control separator, a special token's own text) are one chunk.
Nothing is dropped or shortened.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import xxhash

#: Unicode white space beyond ASCII, and the separators that some engines count as such.
ODD_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
LANES = 4  # a chunk of up to 8 * LANES bytes is compared by its own bytes
PAD = 8 * LANES
VISIBLE = np.ones(256, bool)
VISIBLE[[9, 10, 11, 12, 13, 32]] = False
LETTER, STOP = np.zeros(256, bool), np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
STOP[[33, 44, 46, 58, 59, 63]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], "<u8")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], "<u8")


def load_tokenizer(path: str):
    """A tokenizer of the public library, single-threaded, untouched otherwise."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cut_chunks(texts: list[bytes], whole: list[bool], keep_space: bool, stops: bool = True):
    """(buffer, starts, ends, chunks before each text): the chunks of all texts.

    With ``keep_space`` a chunk is a run of white space and the visible run after
    it, and a text's last white space is a chunk too; else a visible run only.
    With ``stops``, a stop or comma that ends such a run after an ASCII letter is a
    chunk of its own (no pre-token holds both). A text marked ``whole`` is one chunk.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])  # a line end after each text
    buffer = np.frombuffer(b"\n".join([*texts, b"\0" * PAD]), np.uint8)
    visible = VISIBLE[buffer[: base[-1]]]
    for i in np.flatnonzero(whole):
        visible[base[i] : base[i] + sizes[i]] = True
    edges = np.flatnonzero(visible[1:] != visible[:-1]) + 1
    if len(visible) and visible[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    if stops and len(ends):  # a letter's own stop or comma before white space
        cut = np.flatnonzero(STOP[buffer[ends - 1]] & LETTER[buffer[ends - 2]] & (ends - starts > 1))
        ends = ends.copy()
        ends[cut] -= 1
        starts, ends = np.insert(starts, cut + 1, ends[cut]), np.insert(ends, cut + 1, ends[cut] + 1)
    counts = np.searchsorted(starts, base)
    if not keep_space:
        return buffer, starts, ends, counts
    # a chunk starts where the one before ended, or at its text's first byte
    text_of = np.searchsorted(base, starts, "right") - 1
    before = np.concatenate([[0], ends[:-1]])
    starts = np.maximum(before, base[text_of])
    # white space at the end of a text
    last = np.where(counts[1:] > counts[:-1], ends[np.maximum(counts[1:] - 1, 0)] if len(ends) else 0, base[:-1])
    tail = np.flatnonzero(last < base[:-1] + sizes)
    starts = np.insert(starts, counts[1:][tail], last[tail])
    ends = np.insert(ends, counts[1:][tail], (base[:-1] + sizes)[tail])
    extra = np.zeros(len(base), np.int64)
    extra[tail + 1] = 1
    return buffer, starts, ends, counts + np.cumsum(extra)


def chunk_keys(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(hash, identity) of each chunk; identity is length and bytes, or a 256-bit digest if it is long."""
    size = ends - starts
    words = np.ndarray((max(len(buffer) - 7, 0),), "<u8", buffer, strides=(1,))
    identity = np.empty((LANES + 1, len(starts)), "<u8")
    identity[LANES] = size
    top = int(size.max()) if len(size) else 0
    for k in range(LANES):
        if 8 * k >= top:
            identity[k] = 0
            continue
        identity[k] = words[np.minimum(starts + 8 * k, len(words) - 1)]
        identity[k] &= _MASK[np.clip(size - 8 * k, 0, 8)]
    for i in np.flatnonzero(size > PAD):
        data = buffer[starts[i] : ends[i]].tobytes()
        identity[0, i], identity[1, i] = divmod(xxhash.xxh3_128_intdigest(data, 1), 1 << 64)
        identity[2, i], identity[3, i] = divmod(xxhash.xxh3_128_intdigest(data, 2), 1 << 64)
    h = identity[LANES] * _MIX[0]
    for k in range(2):
        h ^= identity[k]
        h *= _MIX[k]
        h ^= h >> np.uint64(29)
    # the longer chunks' other lanes; a chunk's hash never depends on the chunks beside it
    long = np.flatnonzero(size > 16)
    rest = h[long]
    for k in range(2, LANES):
        rest ^= identity[k, long]
        rest *= _MIX[k]
        rest ^= rest >> np.uint64(29)
    h[long] = rest
    return h, identity


class ChunkTable:
    """Open-addressing table from a chunk's hash to its entry number, all in numpy."""

    def __init__(self, max_entries: int):
        self.bits = max(10, int(2 * max_entries - 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.hashes = np.empty(1 << 14, "<u8")
        self.n = 0

    def _slot(self, h):
        return ((h * _MIX[1]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out, todo, slot = np.full(len(h), -1, np.int64), np.arange(len(h)), self._slot(h)
        while len(todo):
            e = self.slots[slot]
            hit = (e >= 0) & (self.hashes[e] == h[todo])
            out[todo[hit]] = e[hit]
            go = (e >= 0) & ~hit
            todo, slot = todo[go], (slot[go] + 1) & (len(self.slots) - 1)
        return out

    def add(self, h: np.ndarray) -> np.ndarray:
        """New entries for distinct hashes that are not in the table."""
        numbers = np.arange(self.n, self.n + len(h))
        self.hashes = grown(self.hashes, self.n + len(h))
        self.hashes[numbers] = h
        self.n += len(h)
        todo, slot = numbers, self._slot(h)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            go = self.slots[slot] != todo
            todo, slot = todo[go], (slot[go] + 1) & (len(self.slots) - 1)
        return numbers


def grown(array: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n columns."""
    if array.shape[-1] >= n:
        return array
    new = np.empty((*array.shape[:-1], max(n, 2 * array.shape[-1])), array.dtype)
    new[..., : array.shape[-1]] = array
    return new


class ChunkEncoder:
    """Ids of whole texts, with a cache of at most ``max_entries`` chunks and ``max_ids`` ids.

    A full cache is emptied, which costs time only.
    """

    keep_space = True

    def __init__(self, path: str, max_entries: int = 1_000_000, max_ids: int = 8_000_000):
        self.tokenizer = load_tokenizer(path)
        self.max_entries, self.max_ids = max_entries, max_ids
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._empty()

    def _empty(self):
        self.table, self.used = ChunkTable(self.max_entries), 0
        self.identity = np.empty((LANES + 1, 1 << 14), "<u8")
        self.at, self.count = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.pool = np.empty(1 << 16, "<u4")

    def _alone(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _prepared(self, texts: list[bytes], whole: list[bool]) -> list[bytes]:
        """The texts, changed as the tokenizer's own normaliser would not mind."""
        return texts

    def _apart(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which chunks must be encoded in a text of their own."""
        raise NotImplementedError

    def _joined(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each chunk) of chunks that are encoded in one text."""
        raise NotImplementedError

    def _encode_new(self, buffer, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each chunk)."""
        apart = self._apart(buffer, starts, ends) | (ends - starts > 1000)
        parts, counts = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        alone, together = np.flatnonzero(apart), np.flatnonzero(~apart)
        for i in range(0, len(alone), 1000):
            spans = zip(starts[alone[i : i + 1000]].tolist(), ends[alone[i : i + 1000]].tolist())
            ids = self._alone([buffer[a:b].tobytes().decode() for a, b in spans])
            parts += [np.array(x, "<u4") for x in ids]
            counts.append(np.array([len(x) for x in ids], np.int64))
        for i in range(0, len(together), 1000):
            own = together[i : i + 1000]
            ids, n = self._joined(buffer, starts[own], ends[own] - starts[own])
            parts.append(ids)
            counts.append(n)
        ids, n = np.concatenate(parts), np.concatenate(counts)
        back = np.empty(len(starts), np.int64)
        back[np.concatenate([alone, together])] = np.arange(len(starts))
        return gather(ids, (np.cumsum(n) - n)[back], n[back]), n[back]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids before each text and in all)."""
        own, chunks_before = self.entries(texts)
        if own is None:  # two chunks of one hash
            alone = [np.array(x, "<u4") for x in self._alone([t.decode() for t in texts])]
            return np.concatenate([*alone, np.empty(0, "<u4")]), np.cumsum([0, *map(len, alone)])
        counts = self.count[own]
        before = np.concatenate([[0], np.cumsum(counts)])
        return gather(self.pool, self.at[own], counts), before[chunks_before]

    def entries(self, texts: list[bytes]) -> tuple[np.ndarray | None, np.ndarray]:
        """(cache entry of each chunk of all texts, chunks before each text)."""
        buffer, starts, ends, chunks_before = self.chunks(texts)
        return self.lookup(buffer, starts, ends), chunks_before

    def chunks(self, texts: list[bytes]):
        """(buffer, starts, ends, chunks before each text)."""
        whole = [bool(ODD_SPACE.search(t)) or any(s in t for s in self.special) for t in texts]
        return cut_chunks(self._prepared(texts, whole), whole, self.keep_space)

    def lookup(self, buffer, starts, ends) -> np.ndarray | None:
        """Cache entry of each chunk, new ones encoded; None if two chunks have one hash."""
        hashes, identity = chunk_keys(buffer, starts, ends)
        codes, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if self.table.n + len(distinct) > self.max_entries or self.used > self.max_ids:
            self.max_entries = max(self.max_entries, 2 * len(distinct))
            self._empty()
        entries = self.table.find(distinct)
        new = np.flatnonzero(entries < 0)
        if len(new):
            at = first[new]
            ids, counts = self._encode_new(buffer, starts[at], ends[at])
            entries[new] = to = self.table.add(distinct[new])
            for name in ("identity", "at", "count"):
                setattr(self, name, grown(getattr(self, name), self.table.n))
            self.pool = grown(self.pool, self.used + len(ids))
            self.identity[:, to] = identity[:, at]
            self.count[to], self.at[to] = counts, self.used + np.cumsum(counts) - counts
            self.pool[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        own = entries[codes]
        if not all((self.identity[k][own] == identity[k]).all() for k in range(LANES + 1)):
            return None
        return own


def gather(pool: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs pool[at[i]:at[i] + counts[i]], one after another."""
    return pool[np.repeat(at, counts) + runs(counts)]


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0]-1, 0, 1, ... counts[1]-1, and so on."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def groups_of(texts: list[bytes], size: int = 4_000_000):
    """Slices of whole texts of about ``size`` bytes."""
    start = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield slice(start, i + 1)
            start, n = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


class ByteLevelEncoder(ChunkEncoder):
    """For byte-level BPE in which a pre-token takes at most one space before it."""

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.piece_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for piece, i in vocab.items():
            self.piece_bytes[i] = len(piece)  # one character a byte

    def _apart(self, buffer, starts, ends):
        return VISIBLE[buffer[starts]] | ~VISIBLE[buffer[ends - 1]]

    def _joined(self, buffer, starts, sizes):
        text = gather(buffer, starts, sizes).tobytes().decode()
        (encoding,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(encoding.ids, "<u4")
        token_ends, ends = np.cumsum(self.piece_bytes[ids]), np.cumsum(sizes)
        at = np.searchsorted(token_ends, ends)
        assert (token_ends[at] == ends).all()
        return ids, np.diff(at, prepend=-1)


class WordEncoder(ChunkEncoder):
    """For BPE over lower-cased NFC words whose pre-tokeniser drops all white space.

    New words are encoded in one text, kept apart by a control character, which
    is a word and an id of its own. ASCII and Latin-1 letters are lower-cased
    here (NFC leaves them alone); other words go through the normaliser.
    """

    MARK = b"\x01"
    keep_space = False

    def __init__(self, path: str, **bounds):
        super().__init__(path, **bounds)
        (self.mark,) = self.tokenizer.encode(self.MARK.decode(), add_special_tokens=False).ids
        self.plain = load_tokenizer(path)
        self.plain.normalizer = None
        #: Bytes outside ASCII and the Latin-1 letters, the mark, and the bar of a special token's text.
        self.other = np.zeros(256, bool)
        self.other[[self.MARK[0], ord("|"), 0xC2]] = self.other[0xC4:] = True

    def _prepared(self, texts, whole):
        lower = [t if w else t.lower() for t, w in zip(texts, whole)]
        return [t if any(s in x for s in self.special) else x for t, x in zip(texts, lower)]

    def _apart(self, buffer, starts, ends):
        before = np.concatenate([[0], np.cumsum(self.other[buffer])])
        return before[ends] > before[starts]

    def _joined(self, buffer, starts, sizes):
        n = sizes + 3
        out = np.empty(int(n.sum()), np.uint8)
        at = np.cumsum(n) - n
        for k, byte in enumerate((32, self.MARK[0], 32)):
            out[at + sizes + k] = byte
        out[np.repeat(at, sizes) + runs(sizes)] = gather(buffer, starts, sizes)
        text = out.tobytes().decode().lower()
        ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        marks = np.flatnonzero(ids == self.mark)
        assert len(marks) == len(sizes)
        return ids[ids != self.mark], np.diff(marks, prepend=-1) - 1
