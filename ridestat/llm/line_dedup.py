"""Line dedup with an edit bound, by a deletion-neighbourhood join (DataFrame operations only).

A line is a text's part between ``\\n``; it is read as its words. Lines with a word (``MIN_WORDS``)
that equal an earlier line (earlier: by doc_id, then place) are removed. Lines of at least
``NEAR_WORDS`` words are also removed if an earlier such line lies within one word edit (a word
replaced, added or left out), whether or not that earlier line stays itself.

Of two lines within one edit, either the front half or the back half of the shorter one stands
unchanged in both. Only distinct lines that share such a half with another go on: they emit their
deletion neighbourhood (the line, and the line without each word) as hashed keys. A replaced word
leaves equal variants at the same place; an added one makes a variant equal to a whole line. Equal
variants meet their group's earliest line only, so a group costs its size; each pair is then
verified on the words themselves.

Defined cases: null text has no lines and stays null; blank lines always stay; rows
with the same doc_id and text are one document (all of them get the same result), null doc_ids come
first; a text may be one line of any length; an empty table gives an empty result. Only doc_id and
text are read, so other columns may have any name not starting with ``__``; columns of the two counts'
names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, stored
from .mixing import WORD, let

MIN_WORDS, NEAR_WORDS = 1, 4
#: Words of 64 bits in the filters that keep lines and documents out of a shuffle; their bound.
FILTER_WORDS = 1 << 17
LINE = ["h1", "h2"]


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, tk (hash of the text), pos, words, n, h1, h2 for each line with a word."""
    each = docs.select("doc_id", F.xxhash64("text").alias("tk"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # a filter on the number of words would be pushed below the split and so split every line twice
    each = each.where(F.col("line").rlike(WORD))
    worded = each.select("doc_id", "tk", "pos", F.regexp_extract_all("line", F.lit(WORD), F.lit(0)).alias("words"))
    return worded.withColumn("n", F.size("words")).withColumn("h1", F.xxhash64("words")).withColumn("h2", F.hash("words"))


def _halves() -> Column:
    """Keys of the halves that a line shares with every line within one edit: as the shorter line, and as the longer."""
    n = F.col("n")
    keys = []
    for short in (n, n - 1):
        front = F.floor(short / 2).cast("int")
        keys.append(F.xxhash64(F.lit("front"), F.slice("words", F.lit(1), front)))
        keys.append(F.xxhash64(F.lit("back"), F.slice("words", n - (short - front) + 1, short - front)))
    return F.when(n >= NEAR_WORDS, F.array_distinct(F.array(*keys)))


def _bits(keys: DataFrame, key: Column) -> DataFrame:
    """A filter of at most FILTER_WORDS rows over the keys' hashes."""
    h = keys.select(F.xxhash64(key).alias("h"))
    bit = F.expr("shiftleft(1L, cast(pmod(h, 64) as int))")
    return h.select(F.pmod(F.shiftright("h", 6), F.lit(FILTER_WORDS)).alias("__word"), bit.alias("bit")).groupBy("__word").agg(F.bit_or("bit").alias("__bits"))


def _maybe(rows: DataFrame, key: Column, bits: DataFrame) -> tuple[DataFrame, Column]:
    """rows with the filter's word beside them, and whether the key may be among the filter's."""
    h = F.xxhash64(key)
    with_bits = rows.withColumn("__h", h).withColumn("__word", F.pmod(F.shiftright("__h", 6), F.lit(FILTER_WORDS)))
    with_bits = with_bits.join(F.broadcast(bits), "__word", "left")  # FILTER_WORDS rows at most
    hit = F.coalesce(F.expr("(shiftright(__bits, cast(pmod(__h, 64) as int)) & 1) = 1"), F.lit(False))
    return with_bits, hit


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _near(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h1, h2 of the lines within one edit of an earlier one."""
    halves = distinct.where("halves is not null").select(*LINE, F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("half")
    wanted = stored(halves.join(shared, "half", "left_semi").select(*LINE).distinct())
    # Words of the wanted lines, from the documents that hold one first.
    firsts = stored(distinct.join(wanted, LINE, "left_semi").select(*LINE, "first"))
    holder = F.struct(F.col("doc_id"), F.xxhash64("text"))
    near, hit = _maybe(docs, holder, _bits(firsts, F.struct("first.doc_id", "first.tk")))
    at = F.struct("doc_id", "tk", "pos").alias("at")
    lines = _lines(near.where(hit)).select(*LINE, "words", "n", at)
    texts = lines.join(firsts, LINE).where(F.col("at").eqNullSafe(F.col("first"))).select(*LINE, "n", "words", "first")
    texts = stored(texts.dropDuplicates(LINE))
    zero = F.lit(0).cast("long")
    placed = F.transform("words", lambda w, i: F.xxhash64(w, i))
    loose = F.transform("words", lambda w: F.xxhash64(w))
    keyed = texts.select(*LINE, "n", "first", placed.alias("placed"), loose.alias("loose"))
    keyed = keyed.withColumn("all_placed", F.aggregate("placed", zero, _xor)).withColumn("all_loose", F.aggregate("loose", zero, _xor))
    without = F.transform("placed", lambda h, i: F.xxhash64(F.lit("replaced"), "n", i, F.col("all_placed").bitwiseXOR(h)))
    line = F.struct("first", *LINE)
    replaced = keyed.select(line.alias("line"), F.explode(without).alias("key"))
    earliest = replaced.groupBy("key").agg(F.min("line").alias("early"), F.count(F.lit(1)).alias("lines")).where("lines > 1").select("key", "early")
    pairs = replaced.join(earliest, "key").where("line > early").select(F.col("line").alias("late"), "early")
    shorter = F.array_distinct(F.transform("loose", lambda h: F.xxhash64(F.lit("left out"), F.col("n") - 1, F.col("all_loose").bitwiseXOR(h))))
    left_out = keyed.select(line.alias("long"), F.explode(shorter).alias("key"))
    whole = keyed.select(line.alias("short"), F.xxhash64(F.lit("left out"), "n", "all_loose").alias("key"))
    met = left_out.join(whole, "key").select(F.greatest("long", "short").alias("late"), F.least("long", "short").alias("early"))
    pairs = pairs.union(met).select(F.col("late.h1").alias("h1"), F.col("late.h2").alias("h2"), F.col("early.h1").alias("e1"), F.col("early.h2").alias("e2")).distinct()
    words = texts.select(*LINE, "words")
    both = pairs.join(words.toDF("h1", "h2", "a"), LINE).join(words.toDF("e1", "e2", "b"), ["e1", "e2"])
    return both.where(within_one_edit(F.col("a"), F.col("b"))).select(*LINE).distinct()


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one word replaced, added or left out (or none) makes the arrays equal."""
    short, long = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)
    n, more = F.size(short), F.size(long) - F.size(short)
    differ = F.zip_with(short, F.slice(long, F.lit(1), n), lambda x, y: x != y)
    at = F.array_position(differ, True).cast("int")  # first place that differs, 0: none
    replaced = F.slice(short, at + 1, n) == F.slice(long, at + 1, n)
    added = F.slice(short, F.greatest(at, F.lit(1)), n) == F.slice(long, at + 1, n)
    return F.when(more == 0, (at == 0) | replaced).when(more == 1, (at == 0) | added).otherwise(False)


def dedup(docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The rows of docs with their remaining lines, and two counts (lines before, lines removed) named by ``counts``."""
    ready(docs.sparkSession)
    texts = docs.select("doc_id", "text").where("text is not null")
    lines = _lines(texts)
    table = stored(lines.select("doc_id", "tk", "pos", *LINE, _halves().alias("halves")))
    place = F.struct("doc_id", "tk", "pos")
    distinct = stored(table.groupBy(*LINE).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("halves").alias("halves")))
    near = stored(_near(texts, distinct))
    gone = distinct.select(*LINE, "first", "last").join(near.withColumn("near", F.lit(True)), LINE, "left")
    gone = gone.where("near or not first <=> last").select(*LINE, "first", F.coalesce("near", F.lit(False)).alias("near"))
    removed = table.select("doc_id", "tk", "pos", *LINE).join(gone, LINE).where(F.col("near") | ~F.struct("doc_id", "tk", "pos").eqNullSafe(F.col("first")))
    by_doc = stored(removed.groupBy(F.col("doc_id").alias("__id"), F.col("tk").alias("__tk")).agg(F.collect_set("pos").alias("__gone")))
    marked = docs.withColumn("__key", F.xxhash64("text"))
    # Documents that lose no line stay out of the shuffle as far as the filter tells.
    known, hit = _maybe(marked, F.struct("doc_id", "__key"), _bits(by_doc, F.struct(F.col("__id").alias("doc_id"), F.col("__tk").alias("__key"))))
    touched, rest = known.where(hit), known.where(~hit)
    on = touched["doc_id"].eqNullSafe(by_doc["__id"]) & (touched["__key"] == by_doc["__tk"])
    joined = touched.join(by_doc, on, "left").withColumn("__left", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("__gone"))))
    rest = rest.withColumn("__left", F.col("text")).withColumn("__gone", F.lit(None).cast("array<int>"))
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    n_lines = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    n_removed = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long")

    def shaped(df: DataFrame) -> DataFrame:
        same = [F.col("__left").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in counts]
        return df.select(*same, n_lines.alias(counts[0]), n_removed.alias(counts[1]))

    return shaped(joined).unionByName(shaped(rest))


def _without(text: Column, gone: Column) -> Column:
    """The text's lines but those at the places in gone."""

    def joined(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: lines[i]), "\n")

    return let(F.split(text, "\n", -1), joined)


def documents_without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The columns of docs; documents that lose all their words go, those that had none stay."""
    counts = ("__n_lines", "__n_removed")
    lost = (F.col(counts[1]) > 0) & ~F.col("text").rlike(WORD)
    return dedup(docs, counts).where(~F.coalesce(lost, F.lit(False))).drop(*counts)
