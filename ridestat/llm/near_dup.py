"""Near-duplicate documents: improved consistent weighted sampling, banded, verified.

A text's features are its five-word windows (a text of one to four words: all of them). A feature
weighs ``(1 + ln(times in the text)) * idf``; idf falls from ``RAREST_IDF`` for features in at most
a ``RARE`` share of the texts to 1 for one that is in all, so what many texts share counts less.

1. Features that reach the rare share are found with mergeable frequency summaries of
   ``COUNTERS`` entries (no such feature can be missing) and then counted exactly in all texts.
2. Each text gets ``BANDS * ROWS`` consistent weighted samples (feature and level with the least
   value); equal samples of a band put texts into one bucket. Exact copies are one text.
3. A bucket of up to ``CENTERS + 1`` texts compares all of its pairs. A larger one is also dealt
   to narrower buckets by two and by four more samples, and in each of its buckets every text meets
   ``LARGE_CENTERS`` texts of different classes, so the pairs stay in proportion to the texts. Pairs
   that agree in enough samples are verified by exact weighted Jaccard similarity; linked texts form
   classes, and in ``ROUNDS`` rounds the classes' texts meet new centers.
4. Texts of large buckets that still hold several classes are joined exactly: two texts that reach the
   threshold share one of their rarest features (``prefixes``), at which enough weight is left in both.
   All such pairs of different classes are verified, in blocks of ``BLOCK`` texts a feature.

Defined cases: texts without a word (null and empty ones too) are a class of their own each; a
class is named by its smallest doc_id; repeated rows fall into one class and the first stays; rows of one
doc_id with different texts are judged apart; rows
with a null doc_id are never removed and have no class; long texts are used whole; an empty table
gives an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, free_name, ready, stored
from .textarrays import chunks, mix, windows, words

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 2
#: Samples of a band and of its narrower forms.
WIDTHS = (2, 4, 6)
#: Samples of a pair that must agree before it is verified (a pair at 0.8 misses this once in 60,000).
AGREE = 8
CENTERS, LARGE_CENTERS = 6, 3
ROUNDS = 3
RARE, RAREST_IDF = 0.01, 1.5
COUNTERS = 1 << 17
FAN_IN = 16
#: Texts of a block of pairs, and counters of the sketch that orders features (the order costs time only, not links).
BLOCK, SKETCH = 512, 1 << 18
_STEPS = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of a chunk's rows: hash, row, times; sorted by row and hash."""
    w = words(data, offsets)
    h, at = windows(w, WORDS)
    row = w.row[at] if len(at) else at
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        with np.errstate(over="ignore"):
            whole = np.zeros(len(short), np.uint64)
            for j in range(WORDS - 1):
                has = n[short] > j
                whole[has] = mix(whole[has] * _ODD + w.hash[w.first[short[has]] + j])
        h, row = np.r_[h, whole], np.r_[row, short]
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(h)
    by_row = row[order]
    order = order[np.argsort(by_row.astype(np.uint16) if len(n) < 1 << 16 else by_row, kind="stable")]
    h, row = h[order], row[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
    return h[first], row[first], np.diff(np.r_[first, len(h)])


class Frequent:
    """A Misra-Gries summary: what occurs more often than total / COUNTERS is in it."""

    def __init__(self) -> None:
        self.keys, self.counts, self.total, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        keys, back = np.unique(np.r_[self.keys, keys], return_inverse=True)
        counts = np.bincount(back, np.r_[self.counts, counts], len(keys)).astype(np.int64)
        if len(keys) > COUNTERS:
            counts = counts - np.partition(counts, len(keys) - COUNTERS - 1)[len(keys) - COUNTERS - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def merged(self, other: Frequent) -> Frequent:
        self.add(other.keys, other.counts)
        self.total, self.rows = self.total + other.total, self.rows + other.rows
        return self


def _per_task(texts: DataFrame, start: Callable, step: Callable, join: Callable):
    """Folds all chunks of texts in tasks, FAN_IN tasks' results at a time on executors, and the last few here; None for no tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                step(state, *features(data, offsets))
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "state": [pickle.dumps(state)]})

    def joined(parts: pd.DataFrame) -> pd.DataFrame:
        state = reduce(join, (pickle.loads(x) for x in parts["state"]))
        return pd.DataFrame({"part": [int(parts["part"].iloc[0]) // FAN_IN], "state": [pickle.dumps(state)]})

    states, left = texts.mapInArrow(run, "part long, state binary"), texts.rdd.getNumPartitions()
    while left > FAN_IN:
        states = states.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(joined, "part long, state binary")
        left = -(-left // FAN_IN)
    states = [pickle.loads(bytes(r["state"])) for r in states.select("state").collect()]  # about FAN_IN bounded summaries
    return reduce(join, states) if states else None


def common_features(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features in at least a RARE share of the texts (sorted) and their idf. Bounded by COUNTERS."""

    def step(state: Frequent, h: np.ndarray, row: np.ndarray, _times: np.ndarray) -> None:
        keys, counts = np.unique(h, return_counts=True)
        state.add(keys, counts)
        state.total += len(h)
        state.rows += int((np.diff(row) > 0).sum()) + 1 if len(row) else 0

    found = _per_task(texts, Frequent, step, lambda a, b: a.merged(b))
    if found is None or not found.rows:
        return np.zeros(0, np.uint64), np.zeros(0)
    rare = max(RARE, found.total / COUNTERS / found.rows)
    # Counts in the summary are low by at most total / COUNTERS.
    keys = found.keys[found.counts + found.total / COUNTERS >= rare * found.rows]
    given = texts.sparkSession.sparkContext.broadcast(keys)

    def count(state: np.ndarray, h: np.ndarray, _row: np.ndarray, _times: np.ndarray) -> None:
        keys = given.value
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            state += np.bincount(at[keys[at] == h], minlength=len(keys))

    counts = _per_task(texts, lambda: np.zeros(len(given.value), np.int64), count, lambda a, b: a + b)
    share = counts / found.rows
    keep = share >= rare
    slope = (RAREST_IDF - 1) / np.log(1 / rare) if rare < 1 else 0.0
    return keys[keep], 1 + slope * np.log(1 / np.minimum(share[keep], 1.0))


def weights(h: np.ndarray, times: np.ndarray, keys: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = np.full(len(h), RAREST_IDF)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        hit = keys[at] == h
        w[hit] = idf[at[hit]]
    return (w * (1 + np.log(times))).astype(np.float32)


def gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of equal steps."""
    p = (np.arange(_STEPS) + 0.5) / _STEPS
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 4)
    return x


class Sampler:
    """Consistent weighted samples of rows of weighted features."""

    def __init__(self, seed: int = 1) -> None:
        g = gamma_table()
        self.r, self.ln_c = g.astype(np.float32), np.log(g).astype(np.float32)
        self.seeds = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) + np.uint64(seed << 32))

    def __call__(self, h: np.ndarray, row: np.ndarray, w: np.ndarray, n_rows: int) -> np.ndarray:
        """(n_rows, BANDS * ROWS) hashes; rows without features stay 0."""
        out = np.zeros((n_rows, len(self.seeds)), np.uint64)
        if not len(h):
            return out
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        lengths, rows = np.diff(np.r_[first, len(h)]), row[first]
        ln_w = np.log(w)
        low = np.uint64(_STEPS - 1)
        with np.errstate(over="ignore"):
            for k, seed in enumerate(self.seeds):
                z = (h ^ seed) * _ODD
                z ^= z >> np.uint64(31)
                z *= np.uint64(0xD6E8FEB86659FD93)
                r = self.r[(z >> np.uint64(48)).astype(np.int64)]
                ln_c = self.ln_c[((z >> np.uint64(32)) & low).astype(np.int64)]
                beta = ((z >> np.uint64(16)) & low).astype(np.float32) / np.float32(_STEPS)
                t = np.floor(ln_w / r + beta)
                ln_a = ln_c - r * (t - beta + 1)
                least = np.repeat(np.minimum.reduceat(ln_a, first), lengths)
                at = np.flatnonzero(ln_a == least)
                at = at[np.r_[True, row[at[1:]] != row[at[:-1]]]]
                out[rows, k] = mix(h[at] * np.uint64(3) + t[at].astype(np.int64).astype(np.uint64) * _ODD)
        return out


def signatures(texts: DataFrame, keys: np.ndarray, idf: np.ndarray) -> DataFrame:
    """doc_id, text_key, samples (binary, 4 bytes each), bands (null for texts without a word)."""
    given = texts.sparkSession.sparkContext.broadcast((keys, idf))
    shape = T.StructType([texts.schema["doc_id"], T.StructField("text_key", T.BinaryType()), T.StructField("samples", T.BinaryType()), T.StructField("bands", T.ArrayType(T.StructType([T.StructField(f"w{n}", T.LongType()) for n in WIDTHS])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, idf = given.value
        sampler = Sampler()
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(2)):
                h, row, times = features(data, offsets)
                s = sampler(h, row, weights(h, times, keys, idf), hi - lo)
                none = np.bincount(row, minlength=hi - lo) == 0
                fields = []
                with np.errstate(over="ignore"):
                    for width in WIDTHS:
                        keys_ = np.zeros((hi - lo, BANDS), np.uint64)
                        for b in range(BANDS):
                            for j in range(width):
                                keys_[:, b] = mix(keys_[:, b] * _ODD + s[:, (b * ROWS + j) % s.shape[1]] + np.uint64(b))
                        fields.append(pa.array(keys_.view(np.int64).ravel()))
                each = pa.StructArray.from_arrays(fields, names=[f"w{n}" for n in WIDTHS])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * BANDS, BANDS), pa.int32()), each, mask=pa.array(none))
                short = (s >> np.uint64(32)).astype("<u4")
                samples = pa.array([x.tobytes() for x in short], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), samples, lists], names=shape.names)

    return texts.select("doc_id", "text_key", "text").mapInArrow(run, shape)


def vectors(texts: DataFrame, keys: np.ndarray, idf: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """The id and v of (id, text): the sorted features (8 bytes each), then their weights (4 bytes each)."""
    given = texts.sparkSession.sparkContext.broadcast((keys, idf))
    shape = T.StructType([texts.schema[id_col], T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, idf = given.value
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1)):
                h, row, times = features(data, offsets)
                w = weights(h, times, keys, idf)
                cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                blobs = [h[s:e].astype("<u8").tobytes() + w[s:e].astype("<f4").tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(blobs, pa.binary())], names=shape.names)

    return texts.select(id_col, "text").mapInArrow(run, shape)


def weighted_jaccard(a: bytes, b: bytes) -> float:
    na, nb = len(a) // 12, len(b) // 12
    ha, hb = np.frombuffer(a, "<u8", na), np.frombuffer(b, "<u8", nb)
    wa, wb = np.frombuffer(a, "<f4", na, na * 8).astype(float), np.frombuffer(b, "<f4", nb, nb * 8).astype(float)
    at = np.minimum(np.searchsorted(hb, ha), nb - 1)
    hit = hb[at] == ha
    both = np.minimum(wa[hit], wb[at[hit]]).sum()
    total = wa.sum() + wb.sum() - both
    return both / total if total else 0.0


def agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs whose samples agree in at least AGREE places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in (2, 3))
                yield batch.filter(pa.array((x == y).sum(1) >= AGREE)).select([0, 1])

    return pairs.mapInArrow(run, T.StructType(pairs.schema.fields[:2]))


def similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """a, b of the pairs (a, b, va, vb) whose weighted Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # vectors are made Python objects a few at a time
                part = batch.slice(at, 256)
                keep = [weighted_jaccard(x, y) >= threshold - 1e-9 for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, T.StructType(pairs.schema.fields[:2]))


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(SKETCH - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(SKETCH - 1)).astype(np.int64)


def sketched(found: DataFrame) -> np.ndarray:
    """Two rows of SKETCH counters of the features of (id, v); the lesser of a feature's two is at least its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = np.zeros((2, SKETCH), np.int64)
        for batch in batches:
            for v in batch.column(0):
                for k, at in enumerate(_slots(np.frombuffer(v.as_buffer(), "<u8", len(v.as_buffer()) // 12))):
                    np.add.at(state[k], at, 1)
        if state.any():
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int64()), "state": [np.minimum(state, (1 << 31) - 1).astype(np.int32).tobytes()]})

    def joined(parts: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(x, np.int32).astype(np.int64) for x in parts["state"]))
        return pd.DataFrame({"part": [int(parts["part"].iloc[0]) // FAN_IN], "state": [np.minimum(total, (1 << 31) - 1).astype(np.int32).tobytes()]})

    states, left = found.select("v").mapInArrow(run, "part long, state binary"), found.rdd.getNumPartitions()
    while left > FAN_IN:
        states = states.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(joined, "part long, state binary")
        left = -(-left // FAN_IN)
    rows = [np.frombuffer(bytes(r["state"]), np.int32).astype(np.int64) for r in states.select("state").collect()]  # FAN_IN at most
    return reduce(np.add, rows, np.zeros(2 * SKETCH, np.int64)).reshape(2, SKETCH)


def prefixes(texts: DataFrame, counts: np.ndarray, threshold: float) -> DataFrame:
    """rid, comp, f, total, rest of texts (rid, comp, v): rarest features first, those at which ``rest``, the weight from there on, still reaches threshold * total.

    Two similar texts have their first common feature f among these, and the lesser rest reaches threshold / (1 + threshold) of both totals.
    """
    given = texts.sparkSession.sparkContext.broadcast(counts)
    shape = T.StructType([*texts.schema.fields[:2], T.StructField("f", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("rest", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = given.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                of, fs, totals, rests = [], [], [], []
                for i, v in enumerate(part.column(2)):
                    b = v.as_buffer()
                    n = len(b) // 12
                    h, w = np.frombuffer(b, "<u8", n), np.frombuffer(b, "<f4", n, n * 8).astype(float)
                    one, two = _slots(h)
                    seen = np.minimum(counts[0][one], counts[1][two])
                    order = np.lexsort((h, seen))
                    rest = np.cumsum(w[order][::-1])[::-1]
                    # What was seen once is in no other text.
                    keep = np.flatnonzero((rest >= threshold * rest[0] - 1e-6) & (seen[order] > 1))
                    of.append(np.full(len(keep), i))
                    fs.append(h[order][keep].view(np.int64))
                    rests.append(rest[keep])
                    totals.append(np.full(len(keep), rest[0]))
                of = pa.array(np.concatenate(of))
                yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), *(pa.array(np.concatenate(x)) for x in (fs, totals, rests))], names=shape.names)

    return texts.mapInArrow(run, shape)


def possible(rows: DataFrame, threshold: float) -> DataFrame:
    """a, b of different classes that share a prefix row and may reach the threshold; all that do are among them."""
    rows = stored(rows)
    several = rows.groupBy("f").agg((F.min("comp") < F.max("comp")).alias("more"), F.count(F.lit(1)).alias("n")).where("more")
    rows = stored(rows.join(several.select("f", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "f"))
    x = rows.select("f", F.pmod(F.xxhash64("rid"), "blocks").cast("int").alias("block"), *[F.col(c).alias(f"{c}_x") for c in ("rid", "comp", "total", "rest")])
    y = rows.select("f", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), *[F.col(c).alias(f"{c}_y") for c in ("rid", "comp", "total", "rest")])
    enough = F.least("rest_x", "rest_y") >= threshold / (1 + threshold) * (F.col("total_x") + F.col("total_y")) - 1e-6
    pairs = x.join(y, ["f", "block"]).where((F.col("rid_x") < F.col("rid_y")) & (F.col("comp_x") != F.col("comp_y")) & enough)
    return pairs.select(F.col("rid_x").alias("a"), F.col("rid_y").alias("b")).distinct()


def merged(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, comp of all linked texts: label with the classes joined that the links join."""
    if label is None:
        return components(links)
    named = label.toDF("node", "named")
    lifted = links.join(named.toDF("a", "la"), "a", "left").join(named.toDF("b", "lb"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    joined = components(lifted).toDF("named", "joined")
    every = named.join(joined, "named", "left").select("node", F.coalesce("joined", "named").alias("comp"))
    fresh = joined.join(named.select(F.col("node").alias("named")), "named", "left_anti").toDF("node", "comp")
    return cut(every.union(fresh))


def components(links: DataFrame) -> DataFrame:
    """node, comp (least node) of the graph of links (a, b): least labels spread, and labels are followed."""
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("comp")))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        spread = label.join(near, "node").select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("old"))
        spread = cut(spread)
        ends = spread.select(F.col("node").alias("comp"), F.col("comp").alias("end"))
        follow = cut(spread.join(ends, "comp", "left").select("node", F.least("comp", "end").alias("comp"), "old"))
        if follow.where("comp <> old").isEmpty():
            return follow.select("node", "comp")
        label = follow.select("node", "comp")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key (of the text), class_id, class_key: one row per row of docs (null doc_ids have a null class).

    class_key tells classes apart also where rows with one doc_id hold different texts (null: a class of its own).
    """
    spark = ready(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.unhex(F.md5("text")))
    keys, idf = common_features(texts.select("text"))
    signed = stored(signatures(texts, keys, idf))
    # One row per distinct text with a number of its own; the classes do not depend on the numbering.
    each = signed.where("bands is not null and doc_id is not null")
    copies = each.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.first("samples").alias("samples"), F.first("bands").alias("bands"))
    copies = stored(copies.withColumn("rid", F.monotonically_increasing_id()))
    band = copies.select("rid", F.posexplode("bands").alias("band", "w")).select("rid", *[F.xxhash64("band", F.lit(n), f"w.w{n}").alias(f"w{n}") for n in WIDTHS])
    wide = f"w{WIDTHS[0]}"
    full = band.groupBy(wide).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = F.when(F.col("n") > CENTERS + 1, F.array(*[f"w{n}" for n in WIDTHS])).otherwise(F.array(wide))
    members = stored(band.join(full, wide).select(F.explode(buckets).alias("bucket"), "rid", F.col("rid").alias("comp")))
    candidates = copies.join(members.select("rid").distinct(), "rid").select("rid", "text_key", F.col("first_id").alias("doc_id"))
    found = stored(vectors(texts.join(candidates, ["doc_id", "text_key"]).dropDuplicates(["rid"]), keys, idf, "rid"))
    samples = copies.select("rid", "samples")
    label = None
    for turn in range(ROUNDS):
        # Buckets of one class have nothing left to tell.
        several = members.groupBy("bucket").agg((F.min("comp") < F.max("comp")).alias("more"), F.count(F.lit(1)).alias("n")).where("more").select("bucket", "n")
        members = stored(members.join(several, "bucket"))
        # Texts to compare with: of up to CENTERS classes of the bucket one each, chosen by a hash.
        one = members.groupBy("bucket", "comp", "n").agg(F.min(F.struct(F.xxhash64("rid", F.lit(turn)).alias("h"), "rid")).alias("c"))
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("c"))
        centers = one.withColumn("place", place).where((F.col("place") <= LARGE_CENTERS) | ((F.col("place") <= CENTERS) & (F.col("n") <= CENTERS + 1))).select("bucket", F.col("c.rid").alias("center"), F.col("comp").alias("center_comp"))
        pairs = members.join(centers, "bucket").where("comp <> center_comp").select(F.least("rid", "center").alias("a"), F.greatest("rid", "center").alias("b")).distinct()
        known = pairs.join(samples.toDF("a", "sa"), "a").join(samples.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        near = agreeing(known)
        links = similar(near.join(found.toDF("a", "va"), "a").join(found.toDF("b", "vb"), "b").select("a", "b", "va", "vb"), threshold)
        links = stored(links)
        if links.isEmpty():
            break
        label = merged(label, links)
        members = members.drop("comp", "n").join(label.toDF("rid", "comp"), "rid", "left").select("bucket", "rid", F.coalesce("comp", "rid").alias("comp"))
    # What the rounds have left open, exactly.
    several = members.groupBy("bucket").agg((F.min("comp") < F.max("comp")).alias("more"), F.count(F.lit(1)).alias("n")).where(F.col("more") & (F.col("n") > CENTERS + 1)).select("bucket")
    left = stored(members.join(several, "bucket").select("rid", "comp").distinct())
    if not left.isEmpty():
        open_texts = left.join(found.toDF("rid", "v"), "rid").select("rid", "comp", "v")
        pairs = possible(prefixes(open_texts, sketched(found), threshold), threshold)
        links = stored(similar(pairs.join(found.toDF("a", "va"), "a").join(found.toDF("b", "vb"), "b").select("a", "b", "va", "vb"), threshold))
        if not links.isEmpty():
            label = merged(label, links)
    named = copies.select("text_key", "rid", "first_id")
    if label is None:
        named = named.select("text_key", F.col("rid").alias("class_key"), F.col("first_id").alias("class_id"))
    else:
        named = named.join(label.toDF("rid", "comp"), "rid", "left")
        linked = named.where("comp is not null")
        ids = linked.groupBy("comp").agg(F.min("first_id").alias("class_id"))
        alone = named.where("comp is null").select("text_key", F.col("rid").alias("class_key"), F.col("first_id").alias("class_id"))
        named = linked.join(ids, "comp").select("text_key", F.col("comp").alias("class_key"), "class_id").union(alone)
    worded = each.select("doc_id", "text_key").join(named, "text_key").select("doc_id", "text_key", "class_id", "class_key")
    rest = signed.where("bands is null or doc_id is null")
    return worded.union(rest.select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(None).cast("long")))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of docs for each class: that of its least doc_id (of several, the first by its text's key)."""
    named = stored(classes(docs, threshold)).where("doc_id is not null")
    first = F.min(F.struct("doc_id", "text_key")).alias("first")
    keep = named.where("class_key is not null").groupBy("class_key").agg(first).select("first.doc_id", "first.text_key")
    keep = keep.union(named.where("class_key is null").select("doc_id", "text_key").distinct()).toDF("kept_id", "kept_text")
    text = free_name(docs.columns, "text_key")
    marked = docs.withColumn(text, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    same = (marked["doc_id"] == keep["kept_id"]) & (marked[text] == keep["kept_text"])
    stay = marked.join(keep, same, "left_semi").dropDuplicates(["doc_id", text])
    return stay.unionByName(marked.where("doc_id is null")).drop(text)
