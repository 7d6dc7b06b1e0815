"""Mixing sources to target weights by pivotal dependent rounding (DataFrame operations only).

``source_targets`` shares the words of all documents over the sources by weight and caps each
source at ``max_repeats`` times its words; the excess goes to the others by weight. The copies a
document should get, target / source words, are split into a whole part and a fraction. Fractions
are rounded by the pivotal method: two documents meet, and words are moved at random from one to
the other (expectation kept) until one fraction is 0 or 1; the other goes on. Documents meet in
hashed chunks of about ``CHUNK_ROWS``; each chunk leaves at most one fraction, and these residuals
meet again, ``CHUNK_ROWS`` chunks at a time, until one is left in each source. Moves keep the words
of the source exactly, so what a source takes misses its target by less than one document.

Defined cases: null text has size 0; a document of size 0 takes 0 words; null sources are one
source, ordered last; repeated rows (same doc_id, source and size) are rounded together and take
the same; an empty table gives an empty result. Only doc_id, text and source are read, so other
columns may have any name. Draws are hashes of the documents' ids and sizes: reruns agree, whatever
the partitions are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, cut, ready

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_ROWS = 64
MAX_REPEATS = 3
SALTS = 64
WEIGHTS = (1, 2, 3)


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) drawn from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text)."""
    return docs.select("doc_id", "source", word_count().alias("size"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source_key, units, source_size, target: one row per source.

    ``sizes`` has source_key (null: the null source), size and rows (how often the row occurs).
    """
    per = sizes.groupBy("source_key").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source_key").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source_key").asc_nulls_last())
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def rest(c: str) -> Column:
        return F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0.0))

    # The words a unit of weight gets if exactly the sources before this one are capped.
    spent = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    per = per.withColumn("level", (F.sum("source_size").over(everything) - spent) / rest("weight"))
    free = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    per = per.withColumn("level", F.first(free, ignorenulls=True).over(everything))
    target = F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap"))
    return per.select("source_key", "units", "source_size", target.alias("target"))


def _pivot(items: Column) -> Column:
    """Folds a chunk's items: ``done`` holds those with a rounded fraction, ``held`` the one left."""
    kind = "struct<held:struct<key:bigint,doc_id:bigint,size:bigint,mass:double,part:double,rest:struct<rows:bigint,whole:bigint,source_size:bigint,target:double>>,done:array<struct<item:struct<key:bigint,doc_id:bigint,size:bigint,mass:double,part:double,rest:struct<rows:bigint,whole:bigint,source_size:bigint,target:double>>,more:int>>>"

    def meet(state: Column, e: Column) -> Column:
        h, done = state["held"], state["done"]

        def moved(p: Column) -> Column:
            # up: words go from e to the held item; down: the other way.
            rise = p["u"] * (p["up"] + p["down"]) < p["down"]
            h_ends = F.when(rise, p["h_room"] <= p["e_mass"]).otherwise(p["h_mass"] <= p["e_room"])
            sign = F.when(rise, 1.0).otherwise(-1.0)
            step = F.when(rise, p["up"]).otherwise(p["down"])
            left = F.when(h_ends, e.withField("part", e["part"] - sign * step / e["mass"])).otherwise(h.withField("part", h["part"] + sign * step / h["mass"]))
            ended = F.when(h_ends, F.struct(h.alias("item"), F.when(rise, 1).otherwise(0).alias("more"))).otherwise(F.struct(e.alias("item"), F.when(rise, 0).otherwise(1).alias("more")))
            return F.struct(left.alias("held"), F.concat(done, F.array(ended)).alias("done"))

        h_room, h_mass = (1 - h["part"]) * h["mass"], h["part"] * h["mass"]
        e_room, e_mass = (1 - e["part"]) * e["mass"], e["part"] * e["mass"]
        pair = F.struct(
            h_room.alias("h_room"), h_mass.alias("h_mass"), e_room.alias("e_room"), e_mass.alias("e_mass"),
            F.least(h_room, e_mass).alias("up"), F.least(h_mass, e_room).alias("down"), _uniform(h["key"], e["key"], F.lit("meet")).alias("u"),
        )
        first = F.struct(e.alias("held"), done.alias("done"))
        return F.when(h.isNull(), first).otherwise(let(pair, moved)).cast(kind)

    start = F.struct(F.lit(None).cast(kind.split("held:")[1].split(",done:")[0]).alias("held"), F.array().alias("done")).cast(kind)
    return F.aggregate(items, start, meet)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 1) -> DataFrame:
    """doc_id, source_key, size, source_size, target, copies, rows: one row per distinct document."""
    ready(docs.sparkSession)
    units = cut(sized(docs).groupBy("doc_id", F.col("source").alias("source_key"), "size").agg(F.count(F.lit(1)).alias("rows")))
    targets = cut(source_targets(units, weights, max_repeats))
    # A null source must meet its own row: join on a text that marks nulls.
    mark = F.coalesce(F.concat(F.lit("="), "source_key"), F.lit("-"))
    # The few rows of targets are repeated under each salt, so a hot source meets its row in many tasks.
    salted = targets.withColumn("mark", mark).drop("source_key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rated = (
        units.withColumn("mark", mark)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
        .join(salted, ["mark", "salt"])
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("rate"))
        .withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("mass", (F.col("size") * F.col("rows")).cast("double"))
        .withColumn("key", F.xxhash64(F.lit(seed), "mark", "doc_id", "size"))
        .withColumn("chunks", F.ceil(F.col("units") / CHUNK_ROWS).cast("long"))
    )
    item = F.struct("key", "doc_id", "size", "mass", "part", F.struct("rows", "whole", "source_size", "target").alias("rest")).alias("item")
    rounds = (F.col("part") > 0) & (F.col("mass") > 0)
    settled = [rated.where(~rounds).select("mark", item, F.lit(0).alias("more"))]
    level = rated.where(rounds).select("mark", F.pmod(F.col("key"), F.col("chunks")).alias("chunk"), item)
    most = targets.agg(F.max("units")).first()[0] or 0
    chunks = -(-most // CHUNK_ROWS)
    while True:
        items = F.sort_array(F.collect_list("item")).alias("items")
        folded = cut(level.groupBy("mark", "chunk").agg(items).select("mark", "chunk", _pivot(F.col("items")).alias("state")))
        settled.append(folded.select("mark", F.inline("state.done")))
        level = folded.select("mark", F.floor(F.col("chunk") / CHUNK_ROWS).alias("chunk"), F.col("state.held").alias("item"))
        if chunks <= 1:
            break
        chunks = -(-chunks // CHUNK_ROWS)
    last = _uniform(F.col("item.key"), F.lit("last")) < F.col("item.part")
    settled.append(level.select("mark", "item", F.when(last, 1).otherwise(0).alias("more")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    source_key = F.when(F.col("mark") != "-", F.substring("mark", 2, 1 << 30)).alias("source_key")
    return out.select(
        "item.doc_id", source_key, "item.size", "item.rest.source_size", "item.rest.target", (F.col("item.rest.whole") + F.col("more")).alias("copies"), "item.rest.rows"
    )


def take(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The mixed documents: each row ``copies`` times, with the columns of ``docs``."""
    size, copy, copies = (free_name(docs.columns, x) for x in ("size", "copy", "copies"))
    left = docs.withColumn(size, word_count())
    d = decisions.where("copies > 0").select("doc_id", "source_key", F.col("size").alias("n"), F.col("copies").alias(copies))
    on = left["doc_id"].eqNullSafe(d["doc_id"]) & left["source"].eqNullSafe(d["source_key"]) & (left[size] == d["n"])
    return left.join(d, on).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[left[c] for c in docs.columns])
