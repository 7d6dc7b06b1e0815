"""Quality rules by n-gram perplexity, with a modified Kneser-Ney model counted by Spark.

The model predicts the bytes of texts (one blank between words) from up to four bytes before, also
across words and from the text's start on; it has one part per language. Tasks count the n-grams of whole texts; Spark sums them and
derives continuation counts, discounts and probabilities by grouping and joins. Texts are scored in
packed blocks of at most ``BLOCK`` bytes: a block's distinct n-grams are joined with their probabilities,
and those rows meet the block's texts again as sorted arrays, so no task or driver holds the model. All
scored texts are counted, so every n-gram has a probability of its own.

A document's cross entropy (bits a symbol) is compared with the band of its language: quartiles over
all documents that pass the base rules, widened by ``BAND`` times their distance on either side, and
for short texts, whose entropy is less certain, by ``SHORT_MARGIN`` over the root of the symbols. A
document outside the band is rejected, as is one that fails the base rules.

Defined cases: null and empty texts have no words and fail the base rules; a null language is a
language of its own; a language whose quartiles coincide still gets a band ``LEAST_SPREAD`` wide;
more than ``LANGUAGES`` distinct languages are an error (map them to fewer before); repeated rows are
judged alike and may lie in several blocks; texts of any length are used whole; an empty table gives an
empty result. Only doc_id, text and lang are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ready, stored
from .textarrays import Words, chunks, mix, owners, ragged, runs, span_hashes, windows, words

ORDER = 5
BAND, LEAST_SPREAD = 3.0, 0.02
#: Bits by which the band is wider for a text of one symbol; it falls with the root of the symbols.
SHORT_MARGIN = 2.0
MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SALTS = 32
#: Languages with a model of their own; their hashes go to every task.
LANGUAGES = 1 << 15
#: Bytes of text handled at once, bytes of a task's texts (about) and of a block of them, n-gram counts kept by a task.
CHUNK, GROUP, BLOCK, KEPT_GRAMS = 1 << 20, 1 << 24, 3 << 23, 1 << 20
#: zstd level of blocks: 3 took 12 % less than 1, 6 another 7 % for three times the CPU.
LEVEL = 3
#: Symbols: bytes, of which a blank stands for a word's end and a line break for a text's start.
BLANK, START, ALPHABET = 0x20, 0x0A, 256
_LANG, _ODD = 44, np.uint64(0x9E3779B97F4A7C15)
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def language() -> Column:
    return F.xxhash64("lang").alias("language")


def known_languages(docs: DataFrame) -> np.ndarray:
    """The sorted hashes of all languages; a language's place among them is its code."""
    rows = docs.select(language()).distinct().limit(LANGUAGES + 1).collect()
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages in column lang")
    return np.sort(np.array([r[0] for r in rows], np.int64))


def language_codes(hashes: pa.Array | pa.ChunkedArray, known: np.ndarray) -> np.ndarray:
    return np.searchsorted(known, np.asarray(hashes))


def symbol_keys(data: np.ndarray, w: Words, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends in each symbol (language, order, bytes), as long as its text and ORDER allow, and the symbol's row."""
    row = w.row
    opens = np.r_[True, row[1:] != row[:-1]][: len(row)]
    lengths = w.end - w.start + 1 + opens
    ends = np.cumsum(lengths)
    begins = ends - lengths
    symbols = np.full(int(ends[-1]) if len(ends) else 0, BLANK, np.int64)
    inner = np.ones(len(symbols), bool)
    inner[begins[opens]], inner[ends - 1] = False, False
    symbols[inner] = data[ragged(w.start, w.end - w.start)]
    symbols[begins[opens]] = START
    place = np.arange(len(symbols)) - np.repeat(begins[opens], np.diff(np.r_[begins[opens], len(symbols)]))
    row = np.repeat(row, lengths)
    order = np.minimum(place + 1, ORDER)
    key = (lang[row] << 4 | order) << 40
    for j in range(min(ORDER, len(symbols))):
        key[j:] |= np.where(place[j:] >= j, symbols[: len(symbols) - j], 0) << (8 * j)
    said = place > 0
    return key[said], row[said]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, back = np.unique(keys, return_inverse=True)
    return known, np.bincount(back, counts, len(known)).astype(np.int64)


def gram_counts(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """key, n: full n-grams of all texts, and the shorter ones at a start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            langs = language_codes(batch.column(1), known)
            for lo, hi, data, offsets in chunks(batch.column(0), CHUNK):
                w = words(data, offsets)
                if not len(w.hash):
                    continue
                held.append(np.unique(symbol_keys(data, w, langs[lo:hi])[0], return_counts=True))
                size += len(held[-1][0])
                if size > KEPT_GRAMS:
                    keys, counts = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    if len(keys) > KEPT_GRAMS // 2:  # Spark sums what is sent early with the rest
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])
                        keys, counts = keys[:0], counts[:0]
                    held, size = [(keys, counts)], len(keys)
        if held:
            keys, counts = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

    return docs.select("text", language()).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def estimate(counts: DataFrame) -> list[tuple[DataFrame, DataFrame | None]]:
    """For each order: (lang, symbols, n, p) of its n-grams, and (lang, symbols, gamma, n) of their contexts, gamma the share left to lower orders."""
    lang, order = F.shiftright("key", _LANG), F.shiftright("key", 40).bitwiseAND(F.lit(15).cast("long"))
    raw = stored(counts.select(lang.alias("lang"), order.alias("order"), F.col("key").bitwiseAND(F.lit((1 << 40) - 1)).alias("symbols"), "n"))
    tables = {ORDER: raw.where(F.col("order") == ORDER).select("lang", "symbols", "n")}
    for n in range(ORDER - 1, 0, -1):  # continuation counts; n-grams that start with START keep their own
        tail = F.col("symbols").bitwiseAND(F.lit((1 << 8 * n) - 1))
        table = tables[n + 1].select("lang", tail.alias("symbols")).groupBy("lang", "symbols").agg(F.count(F.lit(1)).alias("n"))
        if n > 1:
            table = table.union(raw.where(F.col("order") == n).select("lang", "symbols", "n"))
        tables[n] = stored(table)
    out, lower = [], None
    for n in range(1, ORDER + 1):
        rows = tables[n]
        kinds = rows.groupBy("lang").agg(*[F.sum((F.col("n") == k).cast("double")).alias(f"k{k}") for k in (1, 2, 3, 4)])
        y = F.try_divide("k1", F.col("k1") + 2 * F.col("k2"))

        def discount(k: int, y: Column = y) -> Column:
            """The modified discount of counts of k; a plain half k where the counts of counts are no guide."""
            d = k - (k + 1) * y * F.try_divide(f"k{k + 1}", f"k{k}")
            return F.when((F.col("k1") > 0) & (F.col(f"k{k}") > 0) & (d > 0) & (d < k), d).otherwise(k / 2.0)

        kinds = kinds.select("lang", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
        context = F.shiftright("symbols", 8)
        given = rows.withColumn("context", context).join(F.broadcast(kinds), "lang")  # a row per language: LANGUAGES at most
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        given = given.withColumn("off", off)
        totals = given.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("off").alias("free"))
        totals = stored(totals.withColumn("gamma", F.col("free") / F.col("total")))
        parts = given.join(totals, ["lang", "context"])
        own = (F.col("n") - F.col("off")) / F.col("total")
        if lower is None:
            p = own + F.col("gamma") / ALPHABET
            table = parts.select("lang", "symbols", "n", p.alias("p"))
        else:
            tail = F.col("symbols").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1))
            less = lower.select("lang", F.col("symbols").alias("tail"), F.col("p").alias("less"))
            parts = parts.withColumn("tail", tail).join(less, ["lang", "tail"], "left")
            p = own + F.col("gamma") * F.coalesce("less", F.lit(1.0 / ALPHABET))
            table = parts.select("lang", "symbols", "n", p.alias("p"))
        table = stored(table)
        out.append((table, totals.select("lang", F.col("context").alias("symbols"), "gamma", F.col("total").alias("n"))))
        lower = table
    return out


def probabilities(orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """key, v: log2 probability (as a float) of every n-gram that symbol_keys gives."""
    out = None
    for n, (table, _) in list(enumerate(orders, 1))[1:]:
        if n < ORDER:
            table = table.where(F.shiftright("symbols", 8 * (n - 1)) == START)
        key = F.shiftleft("lang", _LANG).bitwiseOR(F.lit(n << 40).cast("long")).bitwiseOR(F.col("symbols"))
        rows = table.select(key.alias("key"), F.log2("p").cast("float").alias("v"))
        out = rows if out is None else out.union(rows)
    return out


def rule_counts(data: np.ndarray, offsets: np.ndarray, w: Words) -> dict[str, np.ndarray]:
    """The base rules' counts of each row."""
    n_rows = len(offsets) - 1

    def per_row(member: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(member)]
        return total[offsets[1:]] - total[offsets[:-1]]

    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[w.start] += 1
    np.add.at(in_word, w.end, -1)
    in_word = np.cumsum(in_word[:-1]).astype(bool)
    start, end = runs(data != 0x0A, offsets)
    line_words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    start, end = start[line_words > 0], end[line_words > 0]
    line_row = owners(offsets, start)
    h, at = windows(w, REPEAT_WINDOW)
    covered = np.zeros(len(w.hash) + 1, np.int32)
    if len(at):
        again = repeated(h, w.row[at])
        np.add.at(covered, at[again], 1)
        np.add.at(covered, at[again] + REPEAT_WINDOW, -1)
    in_repeat = np.r_[0, np.cumsum(np.cumsum(covered[:-1]) > 0)]
    lines = span_hashes(data, start, end)
    return {
        "n_words": np.diff(w.first),
        "word_chars": per_row(in_word & ((data & 0xC0) != 0x80)),
        "n_symbols": per_row(IS_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_row, minlength=n_rows) - np.bincount(line_row[firsts(lines, line_row)], minlength=n_rows),
        "n_repeat_words": in_repeat[w.first[1:]] - in_repeat[w.first[:-1]],
    }


def _sorted_by(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash and row, and where a new (hash, row) starts in it."""
    with np.errstate(over="ignore"):
        key = mix(h ^ (row.astype(np.uint64) * _ODD))
    order = np.argsort(key, kind="stable")
    k = key[order]
    return order, np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)


def repeated(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether each item's hash occurs again in its row."""
    order, new = _sorted_by(h, row)
    group = np.cumsum(new) - 1
    out = np.zeros(len(h), bool)
    out[order] = np.bincount(group)[group] > 1
    return out


def firsts(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The first item of each hash in each row."""
    order, new = _sorted_by(h, row)
    return order[new]


def packed(docs: DataFrame, partitions: int) -> DataFrame:
    """block, texts: the rows (doc_id, lang, text, language) in compressed blocks of at most BLOCK bytes of text; a longer text is a block of its own.

    Rows are sorted in their partition, so a task that is run again gives the same blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        size = 0

        def block() -> pa.RecordBatch:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
                writer.write_table(pa.Table.from_batches(held).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([part + n], pa.int64()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["block", "texts"])

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo, done = 0, 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, done + BLOCK - size, side="right")))
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - done
                lo, done = hi, int(ends[hi - 1])
                if size >= BLOCK or lo < batch.num_rows:
                    yield block()
                    held, size, n = [], 0, n + 1
        if held:
            yield block()

    rows = docs.select("doc_id", "lang", "text", language()).coalesce(partitions)
    return rows.sortWithinPartitions(F.xxhash64("text"), "doc_id", "lang").mapInArrow(run, "block long, texts binary")


def unpacked(texts: pa.Scalar) -> pa.Table:
    with pa.ipc.open_stream(texts.as_buffer()) as reader:
        return reader.read_all()


def measured(docs: DataFrame, model: DataFrame, known: np.ndarray) -> DataFrame:
    """doc_id, lang, the base counts, base_failed and bits (cross entropy a symbol; null without words); model has the n-grams of docs."""
    spark = ready(docs.sparkSession)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shape = T.StructType([docs.schema["doc_id"], T.StructField("lang", T.StringType()), *[T.StructField(c, T.LongType()) for c in counts], T.StructField("bits", T.DoubleType()), T.StructField("symbols", T.LongType())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """block, key: the distinct n-grams of each block."""
        for batch in batches:
            for block, packed_texts in zip(*batch.columns, strict=True):
                texts = unpacked(packed_texts)
                langs, found = language_codes(texts.column("language"), known), [np.zeros(0, np.int64)]
                for lo, hi, data, offsets in chunks(texts.column("text"), CHUNK):
                    found.append(np.unique(symbol_keys(data, words(data, offsets), langs[lo:hi])[0]))
                distinct = np.unique(np.concatenate(found))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), block.as_py())), pa.array(distinct)], names=["block", "key"])

    def run(blocks: pa.Table, grams: pa.Table) -> pa.Table:
        keys, values = grams.column("key").to_numpy(), grams.column("v").to_numpy().astype(float)
        by = np.argsort(keys)
        keys, values = keys[by], values[by]
        parts = []
        for packed_texts in blocks.column("texts"):
            texts = unpacked(packed_texts)
            langs = language_codes(texts.column("language"), known)
            for lo, hi, data, offsets in chunks(texts.column("text"), CHUNK):
                w = words(data, offsets)
                rules = rule_counts(data, offsets, w)
                key, row = symbol_keys(data, w, langs[lo:hi])
                distinct, back = np.unique(key, return_inverse=True)
                at = np.searchsorted(keys, distinct)
                if len(distinct) and (at[-1] >= len(keys) or (keys[at] != distinct).any()):
                    raise ValueError("n-grams without a probability: the texts are not those that were counted")
                n = np.bincount(row, minlength=hi - lo)
                bits = np.bincount(row, -values[at][back], hi - lo) / np.maximum(n, 1)
                columns = [pa.array(rules[c].astype(np.int64)) for c in counts]
                parts.append(pa.table([*(texts.column(c).slice(lo, hi - lo) for c in ("doc_id", "lang")), *columns, pa.array(bits, mask=n == 0), pa.array(n.astype(np.int64))], names=shape.names))
        return pa.concat_tables(parts) if parts else pa.table({f.name: [] for f in shape})

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(size // GROUP + 1, spark.sparkContext.defaultParallelism)
    blocks = packed(docs, wanted).repartition(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))), "block")
    given = blocks.mapInArrow(keys, "block long, key long").join(model, "key").select("block", "key", "v")
    out = blocks.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(run, shape)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def bands(scored: DataFrame, width: float = BAND) -> DataFrame:
    """lang, low, high: the band of each language, from a histogram of a thousandth of a bit."""
    step = F.round(F.col("bits") * 1000).cast("long")
    bins = scored.where("not base_failed").groupBy("lang", step.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("lang")
    upto = F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(by)
    bins = bins.withColumn("upto", upto)
    quartile = [F.min(F.when(F.col("upto") >= q, F.col("bin"))) / 1000 for q in (0.25, 0.75)]
    found = bins.groupBy("lang").agg(quartile[0].alias("q1"), quartile[1].alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_SPREAD)) * width
    return found.select("lang", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


def judge(docs: DataFrame, width: float = BAND) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, perplexity, low and high of the language's band."""
    ready(docs.sparkSession)
    known = known_languages(docs)
    scored = stored(measured(docs, probabilities(estimate(gram_counts(docs, known))), known))
    band = bands(scored, width).withColumnRenamed("lang", "band_lang")
    # The few bands are repeated under each salt, so a language of many rows meets its band in many tasks.
    band = band.withColumn("band_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = scored.withColumn("salt", F.pmod(F.xxhash64("doc_id", "bits"), F.lit(SALTS)).cast("int"))
    mark = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in ("lang", "band_lang")]
    joined = rows.withColumn("mark", mark[0]).join(band.withColumn("band_mark", mark[1]), (F.col("mark") == F.col("band_mark")) & (F.col("salt") == F.col("band_salt")), "left")
    margin = SHORT_MARGIN / F.sqrt(F.greatest("symbols", F.lit(1)))
    inside = F.coalesce((F.col("bits") >= F.col("low") - margin) & (F.col("bits") <= F.col("high") + margin), F.lit(False))
    out = joined.withColumn("kept", ~F.col("base_failed") & inside).withColumn("perplexity", F.pow(F.lit(2.0), "bits"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity", F.pow(F.lit(2.0), "low").alias("low"), F.pow(F.lit(2.0), "high").alias("high"))
