"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A token is a run of letters, digits and non-ASCII bytes, A-Z lower-cased. Its input joins a word
part (an embedding of the words known from training) and a character part (embeddings of its
hashed byte n-grams with border marks, pooled by mean and by maximum). The first place of either
part starts from the training documents' log-odds, drawn to 0 for rare ones. Windows of ``WINDOW``
tokens overlap and cover the whole text; forward and
backward gated units read each, an attention layer pools their states, and a linear layer gives the
window's logit. A document's score is the calibrated logistic of its highest window.

The model is fitted in one task on a bounded sample of labelled rows: at most ``MAX_TOXIC`` and
``MAX_CLEAN`` documents, chosen by a hash of doc_id among labelled texts of at most ``MAX_CHARS``
characters; only the model comes to the driver. Training takes windows every ``STRIDE`` tokens, scoring
those every ``SCORED_STRIDE`` of every text: neighbours share half their tokens, so any passage of up to
17 tokens is whole in one.

Defined cases: a text without a token (null and empty too) scores 0; a doc_id labelled more than
once counts as toxic if one label says so; null labels are none; if either class has no labelled
row, every text scores the share of toxic ones (0 without labels); repeated rows score alike; an
empty table gives an empty result. Only doc_id and text are read, so other columns may have any
name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ready
from .textarrays import chunks, mix, ragged, runs, span_hashes

WINDOW, STRIDE, SCORED_STRIDE = 32, 24, 16
MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1500, 3000, 40_000
HIDDEN, WORD_DIM, CHAR_DIM = 8, 4, 4
BUCKETS = 1 << 17
MAX_WORDS = 1 << 17
GRAMS = (3, 4, 5, 6)
PRIOR = 6
THRESHOLD = 0.3
_ODD = np.uint64(0x9E3779B97F4A7C15)

TOKEN = np.zeros(256, bool)
TOKEN[0x30:0x3A] = TOKEN[0x41:0x5B] = TOKEN[0x61:0x7B] = TOKEN[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Tokens:
    """Tokens of a chunk: hashes of the distinct ones, where each is spelled, and rows of places."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data = LOWER[data]
        start, end = runs(TOKEN[data], offsets)
        self.known, at, self.token = np.unique(span_hashes(self.data, start, end), return_index=True, return_inverse=True)
        self.start, self.end = start[at], end[at]
        self.first = np.searchsorted(start, offsets)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each n-gram length: buckets, and the distinct token each belongs to (ascending)."""
        lengths = self.end - self.start + 2
        ends = np.cumsum(lengths)
        begins = ends - lengths
        marked = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
        marked[begins], marked[ends - 1] = 1, 2
        inner = np.ones(len(marked), bool)
        inner[begins] = inner[ends - 1] = False
        marked[inner] = self.data[ragged(self.start, lengths - 2)]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        with np.errstate(over="ignore"):
            for n in GRAMS:
                m = len(marked) - n + 1
                if m <= 0:
                    continue
                at = np.flatnonzero(owner[:m] == owner[n - 1 :])
                h = np.full(len(at), n, np.uint64)
                for j in range(n):
                    h = h * _ODD + marked[at + j]
                yield (mix(h) >> np.uint64(47)).astype(np.int64), owner[at]

    def windows(self, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each window's row, first token place and length."""
        n = np.diff(self.first)
        count = np.where(n == 0, 0, 1 + np.maximum(0, -(-(n - WINDOW) // stride)))
        row = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        return row, self.first[row] + k * stride, np.minimum(WINDOW, n[row] - k * stride)


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """How much a feature raises the log-odds of toxic; ``PRIOR`` texts of the usual mix are added to its own."""
    usual = n_toxic / max(n_toxic + n_clean, 1)
    share = (toxic + PRIOR * usual) / (toxic + clean + PRIOR)
    return (np.log(share / (1 - share)) - np.log(usual / (1 - usual))).astype(np.float32) if 0 < usual < 1 else np.zeros(len(toxic), np.float32)


class Inputs:
    """Embeddings of words and of n-gram buckets."""

    def __init__(self, rng: np.random.Generator) -> None:
        self.words = np.zeros(0, np.uint64)
        self.word = np.zeros((1, WORD_DIM), np.float32)
        self.gram = (rng.standard_normal((BUCKETS, CHAR_DIM)) * 0.1).astype(np.float32)

    def learn(self, docs: list[Tokens], labels: np.ndarray, rng: np.random.Generator) -> None:
        """Words and log-odds from one-row chunks of tokens and their labels."""
        n = [int((labels == 0).sum()), int((labels == 1).sum())]
        words, back = np.unique(np.concatenate([d.known for d in docs]), return_inverse=True)
        label = np.repeat(labels, [len(d.known) for d in docs])
        seen = [np.bincount(back[label == k], minlength=len(words)) for k in (0, 1)]
        keep = np.flatnonzero(seen[0] + seen[1] >= 2)
        keep = np.sort(keep[np.argsort(-(seen[0] + seen[1])[keep], kind="stable")[:MAX_WORDS]])
        self.words = words[keep]
        self.word = (rng.standard_normal((len(keep) + 1, WORD_DIM)) * 0.1).astype(np.float32)
        self.word[:-1, 0] = _log_odds(seen[1][keep], seen[0][keep], n[1], n[0])
        self.word[-1] = 0  # words not known
        counts = np.zeros((2, BUCKETS), np.int64)
        for d, y in zip(docs, labels, strict=True):
            hit = np.unique(np.concatenate([b for b, _ in d.grams()] or [np.zeros(0, np.int64)]))
            counts[int(y), hit] += 1
        self.gram[:, 0] = _log_odds(counts[1], counts[0], n[1], n[0])

    def places(self, t: Tokens) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(t.known), np.int64)
        at = np.minimum(np.searchsorted(self.words, t.known), len(self.words) - 1)
        return np.where(self.words[at] == t.known, at, len(self.words))

    def __call__(self, t: Tokens) -> np.ndarray:
        """One row per distinct token: word part, most telling n-gram, mean of the n-grams."""
        n = len(t.known)
        top, total, count = np.full(n, -9.0, np.float32), np.zeros((n, CHAR_DIM - 1), np.float32), np.zeros(n, np.float32)
        for bucket, owner in t.grams():
            if len(owner):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                who, v = owner[first], self.gram[bucket]
                top[who] = np.maximum(top[who], np.maximum.reduceat(v[:, 0], first))
                total[who] += np.add.reduceat(v[:, 1:], first)
                count[who] += np.diff(np.r_[first, len(owner)])
        top[count == 0] = 0
        return np.hstack([self.word[self.places(t)], top[:, None], total / np.maximum(count, 1)[:, None]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Two gated recurrent units, attention pooling, one logit; time-major float32 arrays."""

    def __init__(self, n_in: int, rng: np.random.Generator) -> None:
        h = HIDDEN

        def draw(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"x": draw(n_in, 6 * h), "b": np.zeros(6 * h, np.float32), "u0": draw(h, 3 * h), "u1": draw(h, 3 * h)}
        self.p |= {"a": draw(2 * h, h), "ab": np.zeros(h, np.float32), "v": draw(h), "o": draw(2 * h), "ob": np.zeros(1, np.float32)}

    def _unit(self, gates: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
        """States of one direction; gates (time, windows, 3 * HIDDEN): update, reset, new."""
        h = HIDDEN
        state, out = np.zeros((gates.shape[1], h), np.float32), np.empty((*gates.shape[:2], h), np.float32)
        for t in range(len(gates)):
            m = state @ u
            zr = _sigmoid(gates[t, :, : 2 * h] + m[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(gates[t, :, 2 * h :] + r * m[:, 2 * h :])
            nxt = new + z * (state - new)
            if mask is not None:
                nxt *= mask[t][:, None]
            if keep is not None:
                keep.append((state, z, r, new, m[:, 2 * h :]))
            state = out[t] = nxt
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logits of windows from projected inputs (time, windows, 6 * HIDDEN)."""
        h, p = HIDDEN, self.p
        k0, k1 = ([], []) if keep is not None else (None, None)
        back_mask = None if mask is None else mask[::-1]
        ahead = self._unit(gates[:, :, : 3 * h], p["u0"], mask, k0)
        behind = self._unit(gates[::-1, :, 3 * h :], p["u1"], back_mask, k1)[::-1]
        states = np.concatenate([ahead, behind], axis=2)
        hidden = np.tanh(states @ p["a"] + p["ab"])
        e = hidden @ p["v"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-30))
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        pooled = np.einsum("tn,tnk->nk", w, states)
        if keep is not None:
            keep.update(k0=k0, k1=k1, states=states, hidden=hidden, w=w, pooled=pooled)
        return pooled @ p["o"] + p["ob"][0]

    def backward(self, d_logit: np.ndarray, k: dict, mask: np.ndarray, g: dict) -> np.ndarray:
        """Adds the parameters' gradients to g; returns the gates' gradient."""
        h, p = HIDDEN, self.p
        g["o"] += k["pooled"].T @ d_logit
        g["ob"] += d_logit.sum()
        d_pool = d_logit[:, None] * p["o"]
        d_states = k["w"][:, :, None] * d_pool
        d_w = np.einsum("nk,tnk->tn", d_pool, k["states"])
        d_e = k["w"] * (d_w - (k["w"] * d_w).sum(0)) * mask
        g["v"] += np.tensordot(d_e, k["hidden"], ((0, 1), (0, 1)))
        d_hidden = d_e[:, :, None] * p["v"] * (1 - k["hidden"] ** 2)
        g["a"] += np.tensordot(k["states"], d_hidden, ((0, 1), (0, 1)))
        g["ab"] += d_hidden.sum((0, 1))
        d_states += d_hidden @ p["a"].T
        d_gates = np.empty((*d_e.shape, 6 * h), np.float32)
        for which, kept, d_out, m in ((0, k["k0"], d_states[:, :, :h], mask), (1, k["k1"], d_states[::-1, :, h:], mask[::-1])):
            u, d_next = p[f"u{which}"], np.zeros(d_out.shape[1:], np.float32)
            for t in range(len(kept) - 1, -1, -1):
                state, z, r, new, inner = kept[t]
                d = (d_out[t] + d_next) * m[t][:, None]
                d_new = d * (1 - z) * (1 - new**2)
                d_z = d * (state - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_m = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g[f"u{which}"] += state.T @ d_m
                d_next = d * z + d_m @ u.T
                at = t if which == 0 else len(kept) - 1 - t
                d_gates[at, :, 3 * h * which : 3 * h * (which + 1)] = np.concatenate([d_z, d_r, d_new], axis=1)
        return d_gates


class Model:
    """Inputs, network and calibration."""

    BLOCK = 1024

    def __init__(self, seed: int = 1) -> None:
        self.rng = np.random.default_rng(seed)
        self.inputs = Inputs(self.rng)
        self.net = Network(WORD_DIM + CHAR_DIM, self.rng)
        self.slope, self.shift = 1.0, 0.0

    def window_logits(self, t: Tokens, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        gates = self.inputs(t).astype(np.float32) @ self.net.p["x"] + self.net.p["b"]
        gates = np.vstack([gates, np.zeros((1, gates.shape[1]), np.float32)])
        return self._blocks(gates, np.r_[t.token, np.full(WINDOW, len(t.known))], start, length, len(t.known))

    def _blocks(self, table: np.ndarray, token: np.ndarray, start: np.ndarray, length: np.ndarray, blank: int) -> np.ndarray:
        """Logits of windows over tokens that are places in a table of inputs or projected inputs, longest windows first."""
        out = np.empty(len(start), np.float32)
        p = self.net.p
        projected = table.shape[1] == p["x"].shape[1]
        order = np.argsort(-length, kind="stable")
        step = np.arange(WINDOW)[:, None]
        for lo in range(0, len(order), self.BLOCK):
            some = order[lo : lo + self.BLOCK]
            size = int(length[some[0]])
            mask = step[:size] < length[some]
            place = token[start[some] + step[:size]]
            whole = bool(mask.all())
            x = table[place if whole else np.where(mask, place, blank)]
            out[some] = self.net.forward(x if projected else x @ p["x"] + p["b"], None if whole else mask)
        return out

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The highest window logit of each row; -inf without a token."""
        t = Tokens(data, offsets)
        row, start, length = t.windows(SCORED_STRIDE)
        out = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(out, row, self.window_logits(t, start, length))
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = self.logits(data, offsets)
        with np.errstate(over="ignore"):
            return np.where(np.isinf(z), 0.0, _sigmoid(np.clip(self.slope * z + self.shift, -60, 60)))

    def fit(self, texts: list[str], labels: np.ndarray, weights: np.ndarray) -> None:
        """Network and inputs from the labelled texts; calibration on a quarter of its own if there are enough."""
        docs = [Tokens(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())])) for x in texts]
        some = np.array([i for i, d in enumerate(docs) if len(d.known)], np.int64)
        own = self.rng.permutation(len(some)) % 4 == 0 if len(some) >= 1000 else np.zeros(len(some), bool)
        z = self._fit([docs[i] for i in some[~own]], labels[some[~own]])
        if own.any():
            z = np.array([self.window_logits(docs[i], *docs[i].windows(SCORED_STRIDE)[1:]).max() for i in some[own]])
        known = some[own] if own.any() else some
        self._calibrate(z.astype(float), labels[known], weights[known])

    def _fit(self, docs: list[Tokens], labels: np.ndarray, rounds: int = 2, epochs: int = 4) -> np.ndarray:
        """Each round: a toxic text's highest window is toxic, all windows of clean texts are clean."""
        # A document's inputs get their log-odds from the other folds' documents, as those of new texts will.
        folds = 4
        fold = self.rng.permutation(len(docs)) % folds
        crossed = []
        for k in range(folds):
            part, others = Inputs(np.random.default_rng(7)), np.flatnonzero(fold != k)
            part.learn([docs[i] for i in others], labels[others], np.random.default_rng(7))
            crossed.append(part)
        self.inputs.learn(docs, labels, np.random.default_rng(7))
        rows = np.concatenate([crossed[fold[i]](d).astype(np.float32) for i, d in enumerate(docs)] + [np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)])
        # All documents' tokens in one array, each token a place in rows; windows over it.
        shift = np.cumsum([0] + [len(d.known) for d in docs])
        token = np.concatenate([d.token + shift[i] for i, d in enumerate(docs)] + [np.full(WINDOW, len(rows) - 1)])
        before = np.cumsum([0] + [len(d.token) for d in docs])
        spans = [d.windows(STRIDE)[1:] for d in docs]
        start = np.concatenate([w[0] + before[i] for i, w in enumerate(spans)])
        length = np.concatenate([w[1] for w in spans])
        first = np.cumsum([0] + [len(w[0]) for w in spans])
        evidence = np.maximum(rows[:, 0], rows[:, WORD_DIM])[token]
        best = self._highest(np.array([evidence[a : a + n].max() for a, n in zip(start, length, strict=True)]), first)
        moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.net.p.items()}
        owner = np.repeat(np.arange(len(docs)), np.diff(first))
        clean = np.flatnonzero(labels[owner] == 0)
        step = 0
        for _ in range(rounds):
            chosen = np.r_[best, self.rng.choice(clean, min(len(clean), 2 * int((labels == 0).sum())), replace=False)]
            size = min(256, max(32, len(chosen) // 64))
            for _ in range(epochs):
                self.rng.shuffle(chosen)
                for lo in range(0, len(chosen), size):
                    step += 1
                    some = chosen[lo : lo + size]
                    mask = np.arange(WINDOW)[:, None] < length[some]
                    place = np.where(mask, token[start[some] + np.arange(WINDOW)[:, None]], len(rows) - 1)
                    self._train(rows[place], mask, labels[owner[some]], moments, step)
            z = self._blocks(rows, token, start, length, len(rows) - 1)
            best = self._highest(z, first)
        return z[best]

    @staticmethod
    def _highest(z: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The place of each document's highest window."""
        return np.array([a + int(np.argmax(z[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)])

    def _train(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray, moments: dict, step: int) -> None:
        p, kept = self.net.p, {}
        z = self.net.forward(x @ p["x"] + p["b"], mask, kept)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        d_gates = self.net.backward(((_sigmoid(z) - labels) / len(labels)).astype(np.float32), kept, mask, g)
        g["x"] += np.tensordot(x, d_gates, ((0, 1), (0, 1)))
        g["b"] += d_gates.sum((0, 1))
        for k, v in p.items():
            grad = g[k] + np.float32(1e-4) * v
            m, s = moments[k]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad**2 - s)
            v -= np.float32(0.01) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + np.float32(1e-8))

    def _calibrate(self, z: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Weighted logistic regression of the label on the highest logit, slightly drawn to slope 1."""
        a, b = 1.0, 0.0
        for _ in range(50):
            q = _sigmoid(np.clip(a * z + b, -30, 30))
            d, h = weights * (q - labels), weights * q * (1 - q) + 1e-6
            grad = np.array([(d * z).sum() + (a - 1), d.sum()])
            hess = np.array([[(h * z * z).sum() + 1, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, grad), -2, 2)
        self.slope, self.shift = max(float(a), 0.05), float(b)


class Constant:
    """The score of every text where one class has no labelled row."""

    def __init__(self, share: float) -> None:
        self.share = share

    def scores(self, _data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.full(len(offsets) - 1, self.share)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | Constant:
    """A model of ``labels.toxic`` from rows that are not held out."""
    own = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    own = own.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    fit = docs.where(F.length("text") <= MAX_CHARS)
    ids = fit.select("doc_id").join(own, F.col("doc_id") == F.col("label_id")).select("doc_id", "toxic")
    total = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect() if r["toxic"] in (0, 1)}
    if len(total) < 2:
        return Constant(float(bool(total.get(1))))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = ids.where("toxic = 1").orderBy(*by_hash).limit(MAX_TOXIC).union(ids.where("toxic = 0").orderBy(*by_hash).limit(MAX_CLEAN))
    picked = sorted({(r["doc_id"], r["toxic"]) for r in sample.collect()})  # MAX_TOXIC + MAX_CLEAN rows
    id_type = docs.schema["doc_id"].dataType
    named = docs.sparkSession.createDataFrame(picked, T.StructType([T.StructField("picked", id_type), T.StructField("toxic", T.IntegerType())]))
    # Texts of the picked rows only: the label table meets ids alone.
    rows = fit.select("doc_id", "text").join(F.broadcast(named), F.col("doc_id") == F.col("picked")).orderBy("doc_id", "text").limit(MAX_TOXIC + MAX_CLEAN)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))  # MAX_TOXIC + MAX_CLEAN texts of MAX_CHARS at most
        y = table.column("toxic").to_numpy().astype(float)
        weight = np.array([total[int(t)] for t in y]) / np.where(y == 1, max(y.sum(), 1), max((1 - y).sum(), 1))
        model = Model()
        model.fit(table.column("text").to_pylist(), y, weight * len(y) / weight.sum())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return pickle.loads(rows.select("toxic", "text").coalesce(1).mapInArrow(fitted, "model binary").first()["model"])


def score(docs: DataFrame, model: Model | Constant, name: str = "score") -> DataFrame:
    """docs with the score of each row's whole text."""
    given = ready(docs.sparkSession).sparkContext.broadcast(model)
    shape = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [given.value.scores(data, offsets) for _, _, data, offsets in chunks(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else [], pa.float64())], names=shape.names)

    return docs.mapInArrow(run, shape)


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score below the threshold."""
    name = free_name(docs.columns, "toxicity")
    return score(docs, train(docs, labels), name).where(F.col(name) < threshold).drop(name)
