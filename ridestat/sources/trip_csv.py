"""Monthly trip CSV files: header audit, header-group reads, standardised raw rows.

Files differ in delimiter, encoding (UTF-8 with or without BOM, or Latin-1) and header
spelling / order. One multi-file CSV read with differing headers would silently misassign
columns, so:

1. :func:`audit_headers` -- Spark text jobs over all files: per file the first line
   (header), whether every line is valid UTF-8, the detected delimiter and the parsed header.
   The place of each file's first line is broadcast and looked up in the scan, so no line is moved.
   The result has one row per file; it is the only thing collected to the driver.
2. Files are grouped by (encoding, delimiter, header); every group is read with its own
   schema (``enforceSchema=false`` re-checks each file's header against it), columns are
   renamed to the canonical names (first alias present wins), and the groups are
   combined with ``unionByName``.
3. Trip row numbers come from input splits (see :mod:`ridestat.operators.row_index`).
4. Rows whose number of fields differs from the header's come with their text: too few fields leave
   the rest missing, too many stop a load (naming file and row) and are counted by validation
   (:func:`malformed_rows`).

Deliberate differences: encoding is checked over the whole file (not only the first
buffer); a file with quoted line breaks inside fields is read whole by one task.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import CANONICAL_COLUMNS, COLUMN_ALIASES, DEFAULT_DELIMITER, DELIMITER_CANDIDATES
from ..functions.text import na_to_null, normalize_header, py_strip
from ..operators.row_index import index_by_split, split_position_columns

UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
BOM = "\ufeff"
BAD = "__bad_record"  # the text of a row whose number of fields differs from the header's
#: Files whose rows of statistics (a path and a few numbers) are broadcast to the scan.
MAX_BROADCAST_FILES = 1 << 18


def _paths(spark: SparkSession, source: str | list[str]) -> list[str]:
    if isinstance(source, (list, tuple)):
        return list(source)
    return [source.rstrip("/") + "/*.csv"] if not source.endswith(".csv") else [source]


def audit_headers(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """One row per CSV file: path, file, encoding, separator, header (array), columns text.

    * encoding  ``UTF-8`` when every line is valid UTF-8, else ``ISO-8859-1``
    * separator the candidate (``, \\t ; |``) occurring most often in the header line
                (ties in that order), ``,`` when none occurs
    * header    header names split on the separator, surrounding quotes removed, stripped
    * columns   ``" | "``-joined header (the audit report's text)
    """
    lines = spark.read.text(_paths(spark, source)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    # Fixed-width buffers only, so the lines are hash-aggregated; the header line is fetched after.
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    stats = lines.groupBy("path", "file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_or(quotes % 2 == 1).alias("multiline"),  # a quoted line break leaves a line with an odd number of quotes
        F.min(F.when(F.col("block") == 0, F.col("pos"))).alias("pos"),
        F.count(F.lit(1)).alias("lines"),
    )
    stats = stats.checkpoint()  # a row per file, measured here
    few = F.broadcast(stats) if stats.count() <= MAX_BROADCAST_FILES else stats
    heads = lines.where(F.col("block") == 0).select("path", "pos", F.col("value").alias("first_line"))
    per_file = heads.join(few, ["path", "pos"]).drop("pos")
    header = F.when(
        F.col("utf8"), F.regexp_replace("first_line", f"^{BOM}", "")
    ).otherwise(F.decode(F.col("first_line").cast("binary"), LATIN1))
    counts = [
        (F.size(F.split(F.col("header_line"), _regex_escape(d))) - 1).alias(f"n{i}")
        for i, d in enumerate(DELIMITER_CANDIDATES)
    ]
    out = per_file.select(
        "path",
        "file",
        F.when(F.col("utf8"), F.lit(UTF8)).otherwise(F.lit(LATIN1)).alias("encoding"),
        header.alias("header_line"),
        "lines",
        "multiline",
    ).select("*", *counts)
    best = None
    # first candidate with the highest count (ties keep the earlier, more preferred one)
    for i, d in reversed(list(enumerate(DELIMITER_CANDIDATES))):
        others = [F.col(f"n{i}") >= F.col(f"n{j}") for j in range(len(DELIMITER_CANDIDATES)) if j > i]
        others += [F.col(f"n{i}") > F.col(f"n{j}") for j in range(len(DELIMITER_CANDIDATES)) if j < i]
        cond = F.col(f"n{i}") > 0
        for o in others:
            cond = cond & o
        best = F.when(cond, F.lit(d)) if best is None else best.when(cond, F.lit(d))
    sep = best.otherwise(F.lit(DEFAULT_DELIMITER))
    out = out.withColumn("separator", sep)
    raw_names = F.transform(
        F.split(F.col("header_line"), F.concat(F.lit("\\Q"), F.col("separator"), F.lit("\\E"))),
        lambda x: F.regexp_replace(x, r'^"(.*)"$', "$1"),
    )
    names = F.transform(raw_names, lambda x: py_strip(x))
    return out.select(
        "path",
        "file",
        "encoding",
        "separator",
        raw_names.alias("raw_header"),
        names.alias("header"),
        F.array_join(names, " | ").alias("columns"),
        (F.col("lines") - 1).alias("data_lines"),
        "multiline",
    ).orderBy("file")


def _regex_escape(d: str) -> str:
    return "\\t" if d == "\t" else ("\\" + d if d in "|.^$*+?()[]{}\\" else d)


def audit_report(audit: DataFrame) -> DataFrame:
    """The column-audit report: file, separator (as repr text), columns."""
    reprs = {d: repr(d) for d in DELIMITER_CANDIDATES}
    rep = F.col("separator")
    expr = None
    for d, r in reprs.items():
        expr = F.when(rep == d, F.lit(r)) if expr is None else expr.when(rep == d, F.lit(r))
    return audit.select("file", expr.alias("separator"), "columns").orderBy("file")


# ---- header standardisation (a join of header names with the alias table) -----------------


def alias_table(spark: SparkSession) -> DataFrame:
    """normalised alias, canonical column, priority (the first listed alias of a column is preferred)."""
    rows = [(alias, canonical, n) for canonical, aliases in COLUMN_ALIASES.items() for n, alias in enumerate(aliases)]
    listed = spark.createDataFrame(rows, "alias string, canonical string, priority int")
    return listed.select(normalize_header("alias").alias("name_key"), "canonical", "priority").dropDuplicates(["name_key", "canonical"])


def canonical_positions(audit: DataFrame) -> DataFrame:
    """path, canonical, position: which header place feeds each canonical column of a file.

    Of the aliases a header has, the preferred one counts; of equal names, the last place.
    """
    names = audit.select("path", F.posexplode("header").alias("position", "name"))
    hits = names.withColumn("name_key", normalize_header("name")).join(F.broadcast(alias_table(audit.sparkSession)), "name_key")
    choice = F.max(F.struct((-F.col("priority")).alias("preferred"), "position")).alias("choice")
    return hits.groupBy("path", "canonical").agg(choice).select("path", "canonical", "choice.position")


def schema_table(audit: DataFrame) -> DataFrame:
    """file, missing_columns, extra_columns after standardisation."""
    used = canonical_positions(audit).groupBy("path").agg(
        F.collect_set("canonical").alias("found"), F.collect_set("position").alias("places")
    )
    wanted = F.array(*[F.lit(c) for c in CANONICAL_COLUMNS])
    none = F.array().cast("array<string>")
    rest = F.filter("header", lambda name, i: ~F.array_contains(F.coalesce("places", F.array().cast("array<int>")), i))
    return audit.join(used, "path", "left").select(
        "file", F.array_except(wanted, F.coalesce("found", none)).alias("missing_columns"), rest.alias("extra_columns")
    ).orderBy("file")


def schema_report(audit: DataFrame) -> list[dict]:
    """:func:`schema_table` as one entry per file."""
    return [r.asDict() for r in schema_table(audit).collect()]


@dataclass
class HeaderGroup:
    encoding: str
    separator: str
    raw_header: tuple[str, ...]  # as in the file (the read schema)
    multiline: bool  # some quoted field holds a line break: a file is read whole by one task
    positions: dict[str, int]  # canonical column -> place in the header
    paths: list[str] = field(default_factory=list)


def header_groups(audit: DataFrame) -> list[HeaderGroup]:
    """Group files that can share one CSV read (same encoding, delimiter and header)."""
    groups: "OrderedDict[tuple, HeaderGroup]" = OrderedDict()
    places: dict[str, dict[str, int]] = {}
    for r in canonical_positions(audit).collect():  # at most a row per file and canonical column
        places.setdefault(r["path"], {})[r["canonical"]] = r["position"]
    for r in audit.select("path", "encoding", "separator", "raw_header", "multiline").collect():
        key = (r["encoding"], r["separator"], tuple(r["raw_header"]), r["multiline"])
        g = groups.setdefault(key, HeaderGroup(*key, places.get(r["path"], {})))
        g.paths.append(r["path"])
    if not groups:
        raise FileNotFoundError("no CSV files found")
    return list(groups.values())


def _read_group(spark: SparkSession, g: HeaderGroup) -> tuple[DataFrame, list[str]]:
    unique = len(set(g.raw_header)) == len(g.raw_header) and all(g.raw_header)
    names = list(g.raw_header) if unique else [f"_c{i}" for i in range(len(g.raw_header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD]])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", g.separator)
        .option("encoding", g.encoding)
        .option("quote", '"')
        .option("escape", '"')  # RFC 4180: a quote inside a quoted field is doubled
        .option("enforceSchema", not unique)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .option("columnPruning", False)  # else only the columns read are counted
        .option("multiLine", g.multiline)
        .csv(g.paths)
    )
    return df, names


def field_surplus(record: F.Column, first: F.Column, separator: str, n_columns: int) -> F.Column:
    """Fields of a malformed record beyond the header's (negative: fields that it lacks); 0 where there is none.

    ``first`` is any column of the file: Spark refuses to read the record's text alone.
    """
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
    none = F.coalesce(F.length(F.substring(first, 1, 0)), F.lit(0))
    return F.when(record.isNotNull(), fields - n_columns).otherwise(none).cast("int")


def stop_at_surplus(raw: DataFrame) -> DataFrame:
    """Fails when a row with more fields than its header is read, naming its file and place (from 0)."""
    place = F.concat(F.lit(" row "), F.col("row_index").cast("string")) if "row_index" in raw.columns else F.lit("")
    said = F.concat(F.col("source_file"), place, F.lit(": "), F.col("__surplus").cast("string"), F.lit(" fields more than the header"))
    return raw.withColumn("source_file", F.when(F.col("__surplus") > 0, F.raise_error(said)).otherwise(F.col("source_file")))


def malformed_rows(raw: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """file, rows, short_rows, long_rows, first_long_row (from 0) of raw rows read with their row index.

    ``files`` (column file) adds those without rows."""
    is_long = F.col("__surplus") > 0
    counts = raw.groupBy(F.col("source_file").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("__surplus") < 0).alias("short_rows"),
        F.count_if(is_long).alias("long_rows"),
        F.min(F.when(is_long, F.col("row_index"))).alias("first_long_row"),
    )
    if files is not None:
        zeros = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("rows", "short_rows", "long_rows")}
        counts = files.select("file").distinct().join(counts, "file", "full").withColumns(zeros)
    return counts.orderBy("file")


def read_raw_trips(
    spark: SparkSession,
    source: str | list[str],
    audit: DataFrame | None = None,
    require_all_columns: bool = True,
    with_row_index: bool = True,
    keep_surplus: bool | None = None,
) -> DataFrame:
    """Standardised raw trip rows from CSV files.

    Columns: ``source_file``, [``row_index``], the nine canonical text columns, a
    ``__has_<column>`` flag per canonical column, and ``__surplus``: fields beyond the header's
    (negative: too few, the rest is null). Text that a default CSV read treats as
    missing (``NA``, ``null``, ...) is null. With ``require_all_columns`` a file lacking a
    canonical column is an error (the load contract); otherwise the column is null there and
    its flag is false (the validation mode). A row with too many fields stops the read, unless
    ``keep_surplus`` (by default in the validation mode), where its surplus is only counted.
    """
    if keep_surplus is None:
        keep_surplus = not require_all_columns
    audit = audit if audit is not None else audit_headers(spark, source)
    parts = []
    for g in header_groups(audit):
        missing = [c for c in CANONICAL_COLUMNS if c not in g.positions]
        if missing and require_all_columns:
            raise ValueError(f"{g.paths} missing required columns after standardisation: {missing}")
        df, names = _read_group(spark, g)
        by_canonical = {c: names[i] for c, i in g.positions.items()}
        cols = [F.col("_metadata.file_name").alias("source_file")]
        for c in CANONICAL_COLUMNS:
            if c in by_canonical:
                cols.append(na_to_null(F.col(f"`{by_canonical[c]}`")).alias(c))
            else:
                cols.append(F.lit(None).cast("string").alias(c))
        for c in CANONICAL_COLUMNS:
            cols.append(F.lit(c in by_canonical).alias(f"__has_{c}"))
        cols.append(field_surplus(F.col(BAD), F.col(f"`{names[0]}`"), g.separator, len(names)).alias("__surplus"))
        part = df.select(*cols, *[c.alias(n) for n, c in split_position_columns().items()])
        parts.append(part)
    raw = parts[0]
    for p in parts[1:]:
        raw = raw.unionByName(p)
    if with_row_index:
        raw = index_by_split(raw, "source_file")
        ordered = ["source_file", "row_index"]
    else:
        raw = raw.drop("__block", "__pos")
        ordered = ["source_file"]
    raw = raw if keep_surplus else stop_at_surplus(raw)
    return raw.select(*ordered, *CANONICAL_COLUMNS, *[f"__has_{c}" for c in CANONICAL_COLUMNS], "__surplus")
