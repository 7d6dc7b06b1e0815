"""URL filter rules by a sort-merge range join over reversed-host keys.

A host is keyed by its labels in reverse, each closed by a separator, so the keys of a host and all
its subdomains form one interval. Urls are range-partitioned by key (a salt splits a hot host) and
cut off there; every rule goes to each partition that its interval meets. A task sweeps its rows in
key order with a stack of the rules whose interval is open: intervals of prefixes nest, so a rule
is closed when the key stops starting with its own. An open rule fits if the url's path starts with
the rule's path; the longest rule (host and path together, then the longer host) wins.

Defined cases: host is what stands between the first ``://`` and the next ``/``, ``?`` or ``#``
(A-Z lower-cased), path what follows up to ``?`` or ``#``; a null url or one without ``://`` has
both empty. A url that no rule fits gets a null rule and the default verdict. Rules whose host is
null or empty are no rules; a null path is empty; of equal rules with unlike verdicts, block wins.
Repeated urls are judged one by one. Empty tables give empty results. Only the id and url columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ready

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict) of the rules that the query applies.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)


def host_key(host: Column) -> Column:
    """``a.example.org`` -> ``org,example,a,``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(","))


class _OpenRules:
    """Rules of one host whose interval is open."""

    def __init__(self, key: str, host: str) -> None:
        self.key, self.host, self.by_path, self.lengths = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        if self.by_path.get(path) != BLOCK:
            self.by_path[path] = verdict
        if len(path) not in self.lengths:
            self.lengths = sorted({*self.lengths, len(path)}, reverse=True)

    def longest(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        if host != self.host and not host.endswith("." + self.host):
            return None
        for n in self.lengths:
            verdict = self.by_path.get(path[:n]) if n <= len(path) else None
            if verdict:
                return len(self.host) + n, len(self.host), self.host + path[:n], verdict
        return None


def sweep(batches: Iterator[pa.RecordBatch], default: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bin, key, rules first; judged urls out."""
    stack: list[_OpenRules] = []
    bin_now = None
    for batch in batches:
        out: list[tuple] = []
        for b, key, is_url, page, host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("bin", "key", "is_url", "id", "host", "path", "verdict")), strict=True):
            if b != bin_now:
                stack, bin_now = [], b
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if not is_url:
                if not stack or stack[-1].key != key or stack[-1].host != host:
                    stack.append(_OpenRules(key, host))
                stack[-1].add(path, verdict)
                continue
            found = max((x for x in (r.longest(host, path) for r in stack) if x), default=(0, 0, None, default))
            out.append((page, host, path, found[2], found[3]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """id, host, path, rule, verdict: one row per url."""
    spark = ready(urls.sparkSession)
    bins = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col(url_col))
    keyed = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    # The salt lets one host fill several partitions; all of them get the rules they meet.
    placed = cut(keyed.repartitionByRange(bins, "key", F.xxhash64("id", "path")).withColumn("bin", F.spark_partition_id()))
    edges = placed.groupBy("bin").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()  # one row per bin
    if not edges:
        return placed.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    bounds = F.array(*[F.struct(F.lit(e["bin"]).alias("bin"), F.lit(e["low"]).alias("low"), F.lit(e["high"]).alias("high")) for e in edges])
    clean = rules.where("host is not null and host <> '' and verdict is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    clean = clean.withColumn("key", host_key(F.col("host")))
    meets = F.filter(bounds, lambda b: (F.col("key") <= b["high"]) & ((F.col("key") >= b["low"]) | F.startswith(b["low"], F.col("key"))))
    sent = clean.withColumn("bin", F.explode(F.transform(meets, lambda b: b["bin"])))
    id_type = urls.schema[id_col].dataType
    sent = sent.select("bin", "key", F.lit(False).alias("is_url"), F.lit(None).cast(id_type).alias("id"), "host", "path", "verdict")
    rows = placed.select("bin", "key", F.lit(True).alias("is_url"), "id", "host", "path", F.lit(None).cast("string").alias("verdict"))
    both = rows.unionByName(sent).repartition(bins, "bin").sortWithinPartitions("bin", "key", "is_url")
    shape = urls.select(F.col(id_col).alias("id")).schema.add("host", "string").add("path", "string").add("rule", "string").add("verdict", "string")

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        return sweep(batches, default, to_arrow_schema(shape))

    return both.mapInArrow(swept, shape).withColumnRenamed("id", id_col)
