"""Trip and station inputs derived from the driver's tables.

The driver's tables hold no trips, so the registered queries build *raw trip rows* (the nine
text columns a monthly CSV would hold, after header standardisation) from ``events``, and a
*raw station feed* (GBFS ``station_information`` records) from ``nation``. Every value is
deterministic arithmetic on the source row, so the same rows can be rebuilt in SQL.

Mapping (events row -> raw trip):

* start instant  s0 = ts truncated to the second, shifted by ``event_id % 700`` days
* end instant    e0 = s0 + offset seconds, offset by ``event_id % 50``:
                 0 -> 0, 1 -> -300, 2 -> 14 400, 3 -> 93 600, else floor(value * 60)
* Genero_Usuario       by ``event_id % 5``: ``m``, `` F ``, ``O``, ``?``, ``x``
* Edad_Usuario         ``abc`` when ``event_id % 17 = 0``; else ``10 + (user_id*7) % 70``
                       with ``.0`` appended when ``event_id % 3 = 0``
* Bici                 user_id as text
* Ciclo_Estacion_Retiro  ``(user_id*13) % 30`` left-padded to 3 digits
* Ciclo_EstacionArribo   ``""`` when ``event_id % 97 = 0``; else ``(event_id*7) % 30`` with
                         ``.0`` appended when ``event_id`` is even
* Fecha_Retiro         ``31/02/2024`` when ``event_id % 101 = 0``; ``dd/MM/yy`` when
                       ``event_id % 11 = 0``; else ``dd/MM/yyyy``
* Fecha_Arribo         ``dd/MM/yy`` when ``event_id % 11 = 0``; else ``dd/MM/yyyy``
* Hora_Retiro / Hora_Arribo  ``HH:mm:ss``
* source_file          ``yyyy-MM`` of s0 + ``.csv``; row order inside a file = event_id
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.datetimes import truncate_to_second


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip rows: ``source_file``, ``row_key`` (order within the file) + 9 text columns."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    eid = F.col("event_id")
    uid = F.col("user_id")
    s0 = F.timestamp_add("DAY", eid % 700, truncate_to_second(F.col("ts")))
    offset = (
        F.when(eid % 50 == 0, F.lit(0))
        .when(eid % 50 == 1, F.lit(-300))
        .when(eid % 50 == 2, F.lit(14_400))
        .when(eid % 50 == 3, F.lit(93_600))
        .otherwise(F.floor(F.col("value") * 60))
    ).cast("bigint")
    ev = ev.select("event_id", "user_id", s0.alias("s0"), offset.alias("offset"))
    ev = ev.withColumn("e0", F.timestamp_add("SECOND", F.col("offset"), F.col("s0")))

    def day_text(ts: str, two_digit: F.Column) -> F.Column:
        return F.when(two_digit, F.date_format(ts, "dd/MM/yy")).otherwise(F.date_format(ts, "dd/MM/yyyy"))

    short_year = eid % 11 == 0
    return ev.select(
        F.concat(F.date_format("s0", "yyyy-MM"), F.lit(".csv")).alias("source_file"),
        eid.alias("row_key"),
        F.element_at(F.array(*[F.lit(g) for g in ["m", " F ", "O", "?", "x"]]), (eid % 5 + 1).cast("int"))
        .alias("Genero_Usuario"),
        F.when(eid % 17 == 0, F.lit("abc"))
        .otherwise(
            F.concat(
                (F.lit(10) + (uid * 7) % 70).cast("string"),
                F.when(eid % 3 == 0, F.lit(".0")).otherwise(F.lit("")),
            )
        )
        .alias("Edad_Usuario"),
        uid.cast("string").alias("Bici"),
        F.lpad(((uid * 13) % 30).cast("string"), 3, "0").alias("Ciclo_Estacion_Retiro"),
        F.when(eid % 101 == 0, F.lit("31/02/2024")).otherwise(day_text("s0", short_year)).alias("Fecha_Retiro"),
        F.date_format("s0", "HH:mm:ss").alias("Hora_Retiro"),
        F.when(eid % 97 == 0, F.lit(""))
        .otherwise(
            F.concat(
                ((eid * 7) % 30).cast("string"),
                F.when(eid % 2 == 0, F.lit(".0")).otherwise(F.lit("")),
            )
        )
        .alias("Ciclo_EstacionArribo"),
        day_text("e0", short_year).alias("Fecha_Arribo"),
        F.date_format("e0", "HH:mm:ss").alias("Hora_Arribo"),
    )


def raw_station_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GBFS-shaped station records (one row per station) derived from ``nation``.

    short_name = n_nationkey as text (keys 25-29 used by trips are therefore unknown),
    name = n_name with a line break for odd keys, lat/lon as text ``19 + k/100`` and
    ``-99 - k/100`` (``n/a`` for k = 7), capacity ``10 + k`` (0 for k = 3),
    rental_methods an array for even region keys and missing otherwise.
    """
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(
        k.cast("string").alias("station_id"),
        F.concat(F.lit("ext-"), k.cast("string")).alias("external_id"),
        k.cast("string").alias("short_name"),
        F.when(k % 2 == 1, F.concat(F.col("n_name"), F.lit("\n"))).otherwise(F.col("n_name")).alias("name"),
        F.when(k == 7, F.lit("n/a")).otherwise((F.lit(19.0) + k / 100.0).cast("string")).alias("lat"),
        F.when(k == 7, F.lit("n/a")).otherwise((F.lit(-99.0) - k / 100.0).cast("string")).alias("lon"),
        F.when(k == 3, F.lit(0)).otherwise(F.lit(10) + k).cast("string").alias("capacity"),
        F.when(F.col("n_regionkey") % 2 == 0, F.array(F.lit("KEY"), F.lit("CREDITCARD"))).alias("rental_methods"),
        (F.col("n_regionkey") % 2 == 0).alias("has_kiosk"),
    )


FEED_TIME = 1_700_000_000


def gbfs_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A discovery and a station_information document (one JSON text each) derived from ``nation``.

    Discovery: languages ``es`` (even region keys) and ``en``; feed ``feed<key % 10>`` at
    ``https://feeds.test/<key>.json`` in key order. Stations as :func:`raw_station_records`, with
    ``rental_methods`` a list, the text ``KEY`` (key % 5 = 1 among those without a list) or missing.
    """
    n = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    feed = F.struct(
        F.concat(F.lit("feed"), (k % 10).cast("string")).alias("name"),
        F.concat(F.lit("https://feeds.test/"), k.cast("string"), F.lit(".json")).alias("url"),
    )
    language = F.when(F.col("n_regionkey") % 2 == 0, "es").otherwise("en")
    listed = n.groupBy(language.alias("language")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), feed.alias("feed")))).alias("x"))
    per_language = F.struct(F.transform("x", lambda e: e["feed"]).alias("feeds"))
    data = listed.agg(F.map_from_entries(F.collect_list(F.struct("language", per_language))).alias("data"))
    discovery = data.select(F.to_json(F.struct(F.lit(FEED_TIME).alias("last_updated"), "data")).alias("value"))

    records = raw_station_records(spark, sf_dir)
    one = F.to_json(F.struct(*[c for c in records.columns if c != "rental_methods"]))
    methods = F.when(F.col("rental_methods").isNotNull(), F.concat(F.lit('"rental_methods":'), F.to_json("rental_methods"))).when(
        F.col("station_id").cast("int") % 5 == 1, F.lit('"rental_methods":"KEY"')
    )
    text = F.concat(F.expr("left({0}, length({0}) - 1)".format("body")), F.coalesce(F.concat(F.lit(","), "methods"), F.lit("")), F.lit("}"))
    bodies = records.select(F.col("station_id").cast("int").alias("k"), one.alias("body"), methods.alias("methods")).select("k", text.alias("body"))
    joined = bodies.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "body"))), lambda e: e["body"]), ",\n").alias("all"))
    head = F.lit(f'{{"last_updated": {FEED_TIME}, "data": {{"stations": [\n')
    return discovery, joined.select(F.concat(head, "all", F.lit("]}}")).alias("value"))
