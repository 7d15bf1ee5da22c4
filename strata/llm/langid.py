"""Language ID (3): a bidirectional gated recurrent network over bytes.

The network (Cho et al., 2014) is trained on the driver by backpropagation
through time in numpy, on a bounded sample: at most about ``SAMPLE_DOCS`` rows a
language, found by a hash of the id, and one snippet of ``SNIPPET`` characters,
from a hashed place, of each. Prediction reads whole texts in Arrow batches: every
byte is in one window of ``WINDOW`` bytes, both directions run over all windows
of a group of texts at once, every position gets a distribution over the
languages, and a document's probabilities are their mean over its letters.

Defined results: a text that is null or has no letter is ``und`` with score 0, as
is every text if no row is labelled; null labels are not learned; a row with a
null id is not held out; repeated rows are predicted row by row; an empty table
gives no rows; columns other than ``keep`` are left out. Only the text is an
input of a prediction.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table, utf8
from strata.llm.encode import groups_of

WINDOW = 64
HIDDEN = 8
SAMPLE_DOCS = 500  # rows a language, about
SNIPPET = 320  # characters of each
STEPS = 500  # of the descent
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
#: Bytes that letters are made of: ASCII letters and every byte of a longer character.
LETTERS = np.zeros(256, np.float32)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = 1
ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text.decode())))


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows by bytes, zero after a text's end; windows of each text)."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts], np.int64)
    data = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts.tolist()))
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), counts


class Gru:
    """One direction. Gates z and r share a table of byte inputs with the candidate."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.h = hidden
        self.x = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)  # byte inputs: z, r, candidate
        self.x[:, :hidden] += 1.0  # z near 1: remember at first
        self.u = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)

    def params(self):
        return [self.x, self.u]

    def run(self, steps, keep: bool = False):
        """Hidden states, step by step; ``steps``: byte rows in the order to read. With ``keep``, what backward needs."""
        k, n = self.h, steps.shape[1]
        h = np.zeros((n, k), np.float32)
        out, kept = np.empty((len(steps), n, k), np.float32), []
        x = self.x.copy()
        x[:, : 2 * k] *= 0.5  # sigmoid(v) = tanh(v / 2) / 2 + 1 / 2
        u = self.u.copy()
        u[:, : 2 * k] *= 0.5
        for t, b in enumerate(steps):
            xt = x[b]
            hu = h @ u
            gates = hu[:, : 2 * k] + xt[:, : 2 * k]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r, hn = gates[:, :k], gates[:, k:], hu[:, 2 * k :]
            c = np.tanh(r * hn + xt[:, 2 * k :])
            if keep:
                kept.append((b, h, z, r, hn, c))
            h = c + z * (h - c)
            out[t] = h
        return out, kept

    def backward(self, kept, grads):
        """Gradients of (x, u) from those of the states."""
        k = self.h
        gx, gu = np.zeros_like(self.x), np.zeros_like(self.u)
        carried = np.zeros_like(grads[0])
        for (b, h, z, r, hn, c), g in zip(reversed(kept), grads[::-1]):
            g = g + carried
            dc = g * (1 - z) * (1 - c * c)
            dz = g * (h - c) * z * (1 - z)
            dr = dc * hn * r * (1 - r)
            d = np.concatenate([dz, dr, dc], axis=1)
            np.add.at(gx, b, d)
            du = np.concatenate([dz, dr, dc * r], axis=1)
            gu += h.T @ du
            carried = g * z + du @ self.u.T
        return [gx, gu]


class Tagger:
    """Both directions and a softmax over the languages at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Gru(rng, hidden), Gru(rng, hidden)
        self.v = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def params(self):
        return [*self.ahead.params(), *self.back.params(), self.v, self.bias]

    def _states(self, steps, keep=False):
        a, ka = self.ahead.run(steps, keep)
        b, kb = self.back.run(steps[::-1], keep)
        return np.concatenate([a, b[::-1]], axis=2), ka, kb

    def _softmax(self, states):
        y = states @ self.v + self.bias
        y -= y.max(axis=2, keepdims=True)
        np.exp(y, out=y)
        y /= y.sum(axis=2, keepdims=True)
        return y

    def step(self, windows: np.ndarray, labels: np.ndarray):
        """Gradients of the mean cross-entropy over the letters' positions."""
        steps = np.ascontiguousarray(windows.T)
        states, ka, kb = self._states(steps, keep=True)
        d = self._softmax(states)
        d[:, np.arange(len(labels)), labels] -= 1
        weight = LETTERS[steps]
        d *= (weight / max(1.0, float(weight.sum())))[:, :, None]
        flat, flat_d = states.reshape(-1, states.shape[2]), d.reshape(-1, d.shape[2])
        gs = d @ self.v.T
        k = self.ahead.h
        ga = self.ahead.backward(ka, gs[:, :, :k])
        gb = self.back.backward(kb, gs[::-1, :, k:])
        return [*ga, *gb, flat.T @ flat_d, flat_d.sum(axis=0)]

    def train(self, windows, labels, steps: int = STEPS, batch: int = 128, rate: float = 0.02, seed: int = 11):
        """Adam over shuffled windows, again and again: as many steps for a small sample as for a large one."""
        rng = np.random.default_rng(seed)
        params = self.params()
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        order = np.empty(0, np.int64)
        for t in range(1, steps + 1 if len(windows) else 1):
            if not len(order):
                order = rng.permutation(len(windows))
            own, order = order[:batch], order[batch:]
            lr = rate * (1 - (t - 1) / steps) + 1e-4
            for p, g, a, b in zip(params, self.step(windows[own], labels[own]), m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= lr * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
        return self

    def sums(self, windows: np.ndarray, group: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Of each window: its letters' probabilities added up, and the letters."""
        total, letters = [], []
        for i in range(0, len(windows), group):
            steps = np.ascontiguousarray(windows[i : i + group].T)
            weight = LETTERS[steps]
            p = self._softmax(self._states(steps)[0])
            p *= weight[:, :, None]
            total.append(p.sum(axis=0))
            letters.append(weight.sum(axis=0))
        return np.concatenate(total), np.concatenate(letters)

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Language and mean probability of each text."""
        lettered = [has_letter(t) for t in texts]
        windows, counts = windows_of([t if ok else b"" for t, ok in zip(texts, lettered)])
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not len(windows) or not self.languages:
            return names, scores
        total, letters = self.sums(windows)
        ends = np.cumsum(counts)
        own = np.flatnonzero(counts)
        p = np.add.reduceat(total.astype(np.float64), (ends - counts)[own], axis=0)
        p /= np.add.reduceat(letters.astype(np.float64), (ends - counts)[own])[:, None]
        best = p.argmax(axis=1)
        for i, k, s in zip(own.tolist(), best.tolist(), p.max(axis=1).tolist()):
            names[i], scores[i] = self.languages[k], min(1.0, max(0.0, s))
        return names, scores


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def train_on(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Tagger:
    """A network trained on rows that are not held out and have a label."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Tagger([])
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    place = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    sample = (
        rows.where(F.pmod(place, F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
        .select("lang", place.alias("place"), F.length("text").alias("n"), "text")
        .select("lang", "place", F.expr(
            f"substring(text, 1 + cast(pmod(place, greatest(1, n - {SNIPPET})) as int), {SNIPPET})").alias("text"))
        .collect()
    )
    seen = sorted({(r["lang"], r["text"]) for r in sample})
    texts = [t.encode() for _, t in seen]
    windows, n = windows_of(texts)
    labels = np.repeat([languages.index(x) for x, _ in seen], n)
    used = LETTERS[windows].sum(axis=1) >= 8
    return Tagger(languages).train(windows[used], labels[used])


def identify(docs: DataFrame, tagger: Tagger, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score."""
    out = T.StructType([*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()),
                        T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(0))
            names, scores = [], []
            for part in groups_of(texts):
                a, b = tagger.predict(texts[part])
                names += a
                scores += b
            columns = [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return docs.select(F.col("text").cast("string").alias("_text"), *keep).mapInArrow(run, out)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = identify(docs, train_on(docs), keep=("doc_id",))
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
