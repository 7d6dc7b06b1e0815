"""Tables the registered queries read, built once per input folder.

The pipeline's own shape is *load once, report many times*: raw monthly files are landed,
``trips_clean`` / ``stations`` are written, and every report reads those tables (so filters
reach the Parquet scan and only the used columns are read). For the driver's test folders the
same happens with inputs derived from its tables:

* ``raw_trips``   proxy raw trip rows (text columns + ``row_index``), one folder per source file
* ``catalog``     cleaned GBFS station catalog (as published)
* ``stations``    the stations table (normalised keys)
* ``trips_clean`` 20 columns, partitioned by year / month
* ``csv/``        (on demand) the raw rows landed as CSV files in two header groups and the
                  catalog as CSV, loaded again through the CSV front door (``csv/db``)
* ``csv_dirty/``  (on demand) the same rows as files with malformed rows and other headers

Everything is written under ``<spark checkpoint dir>/ridestat-store/<input fingerprint>``, i.e.
the shared folder the cluster names, and rebuilt whenever the inputs change.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import threading
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CANONICAL_COLUMNS, TRIPS_CLEAN_COLUMNS
from ..operators.clean import clean_trips
from ..operators.row_index import index_by_key
from ..operators.stations import StationDim, as_stations_table, clean_station_information
from ..session import ensure_checkpoint_dir
from ..sinks.tables import exists, read_table, table_exists, write_table
from ..sources import gbfs, proxy
from ..sources.stations_csv import write_station_catalog
from ..sources.trip_csv import audit_headers, read_raw_trips
from .views import trips_analysis

_LOCK = threading.Lock()
_DIMS: dict[str, tuple[int, bool]] = {}  # store folder -> measured (rows, unique) of its stations
PROXY_INPUTS = ("events", "nation")
FORMAT = "3"  # part of the fingerprint: raised when the tables' layout or rules change


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """A hash of the inputs' files (path, length, modification time), asked of the store they are in."""
    sc = spark.sparkContext
    h = hashlib.sha256(FORMAT.encode())
    for name in PROXY_INPUTS:
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        h.update(str(fs.makeQualified(path)).encode())
        if fs.exists(path):
            files = fs.listFiles(path, True)
            seen = []
            while files.hasNext():
                f = files.next()
                seen.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
            h.update("|".join(sorted(seen)).encode())
    return h.hexdigest()[:20]


def store_root(spark: SparkSession, sf_dir: str) -> str:
    """The tables' folder. Where the cluster names spark.checkpoint.dir, later applications find it again."""
    own = ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or own
    return f"{base.rstrip('/')}/ridestat-store/{_fingerprint(spark, sf_dir)}"


class TripStore:
    """Handle on the built tables for one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = store_root(spark, sf_dir)
        self._dim: StationDim | None = None
        self._csv_db = None
        with _LOCK:
            self._build()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _build(self) -> None:
        spark, sf = self.spark, self.sf_dir
        if not table_exists(spark, self.path("raw_trips")):
            # the row-index window deals every file to all tasks: range-partition by file first
            raw = index_by_key(proxy.raw_trips(spark, sf), "source_file", "row_key")
            write_table(raw, self.path("raw_trips"), partition_by=["source_file"], cluster_by=["row_key"])
        if not table_exists(spark, self.path("catalog")):
            write_table(clean_station_information(proxy.raw_station_records(spark, sf)), self.path("catalog"))
        if not table_exists(spark, self.path("stations")):
            write_table(as_stations_table(read_table(spark, self.path("catalog"))), self.path("stations"))
        if not table_exists(spark, self.path("trips_clean")):
            trips = clean_trips(self.raw(), self.dim())
            # raw rows are stored per source month, so each task meets one or two start months
            write_table(trips, self.path("trips_clean"), partition_by=["year", "month"])

    # ---- readers -------------------------------------------------------------------------
    def raw(self) -> DataFrame:
        return read_table(self.spark, self.path("raw_trips"))

    def catalog(self) -> DataFrame:
        return read_table(self.spark, self.path("catalog")).orderBy("station_number")

    def stations(self) -> DataFrame:
        return read_table(self.spark, self.path("stations"))

    def dim(self) -> StationDim:
        if self._dim is None:
            key = self.path("stations")
            if key in _DIMS:
                rows, unique = _DIMS[key]
                self._dim = StationDim(self.stations(), rows, unique)
            else:
                self._dim = StationDim.of(self.stations())
                _DIMS[key] = (self._dim.rows, self._dim.unique)
        return self._dim

    def trips(self) -> DataFrame:
        return read_table(self.spark, self.path("trips_clean")).select(*TRIPS_CLEAN_COLUMNS)

    def analysis(self) -> DataFrame:
        return trips_analysis(self.trips())

    # ---- the same trips through the CSV front door -----------------------------------------
    def csv_database(self):
        """The raw rows landed as monthly CSV files and loaded by the real CSV pipeline.

        Odd months: canonical headers, ``,``, UTF-8. Even months: alias / accented / padded
        headers in another order plus an extra column, ``;``, Latin-1 (with quoted line breaks in
        February). Files bear their months' names and are read in about three splits each (those with
        line breaks whole). The catalog goes through its CSV sink (with BOM) and source. The load is
        :func:`pipeline.build_database`.
        """
        from .pipeline import Database, build_database  # local: pipeline is a heavier module

        if self._csv_db is not None:
            return self._csv_db
        root = self.path("csv")
        db = Database(self.spark, f"{root}/db")
        with _LOCK:
            if not table_exists(self.spark, db.path("trips_clean")):
                land_trip_csvs(self.raw(), f"{root}/trips")
                write_station_catalog(self.catalog(), f"{root}/station_catalog")
                with _small_splits(self.spark, f"{root}/trips"):
                    build_database(self.spark, f"{root}/trips", f"{root}/station_catalog", db.root)
        self._csv_db = db
        return db

    def repeated_dim(self) -> StationDim:
        """The stations, every fifth number listed a second time with another name, and two rows without a number."""
        number = F.col("station_number").cast("int")
        again = self.stations().where(number % 5 == 0).withColumns({"station_name": F.concat("station_name", F.lit(" bis")), "capacity": (F.col("capacity") + 1).cast("int")})
        blank = self.stations().where(number < 2).withColumn("station_number", F.lit(""))
        return StationDim.of(self.stations().unionByName(again).unionByName(blank))

    def report_file(self, name: str) -> str:
        """A CSV report that the export and validation jobs wrote from the landed trip files and their database."""
        from .pipeline import export_dashboards, missing_station_report, validate_trip_files

        root, db = self.path("csv"), self.csv_database()
        with _LOCK:
            if not table_exists(self.spark, f"{root}/reports_done"):
                export_dashboards(self.spark, db.root, f"{root}/reports")
                for job in (validate_trip_files, missing_station_report):
                    job(self.spark, f"{root}/trips", f"{root}/station_catalog", f"{root}/reports")
                write_table(self.spark.range(1), f"{root}/reports_done")
        return f"{root}/reports/{name}"

    def csv_files(self) -> list[str]:
        """The landed files: those of :meth:`csv_database` and the dirty ones of :meth:`dirty_csv`."""
        self.csv_database()
        return [f"{self.path('csv')}/trips/*.csv", f"{self.dirty_csv()}/*.csv"]

    def gbfs(self) -> tuple[str, str, str]:
        """Landed discovery and station_information documents, and a raw layer with two snapshots of the latter."""
        root = self.path("gbfs")
        with _LOCK:
            if not table_exists(self.spark, f"{root}/landed"):
                for name, doc in zip(("discovery", "stations"), proxy.gbfs_documents(self.spark, self.sf_dir), strict=True):
                    doc.coalesce(1).write.mode("overwrite").text(f"{root}/{name}")
                for day in (1, 2):
                    gbfs.save_raw_snapshot(self.spark, f"{root}/stations", f"{root}/raw", now=dt.datetime(2024, 1, day, 12, tzinfo=dt.timezone.utc))
                write_table(self.spark.range(1), f"{root}/landed")
        return f"{root}/discovery", f"{root}/stations", f"{root}/raw"

    def dirty_csv(self) -> str:
        """A folder of monthly files with rows too long and too short, missing and extra columns, and no rows."""
        out = self.path("csv_dirty")
        with _LOCK:
            if not exists(self.spark, f"{out}/{EMPTY_FILE}"):
                land_dirty_csvs(self.raw(), out)
        return out

    def dirty_raw(self) -> tuple[DataFrame, DataFrame]:
        """The dirty files' rows as validation reads them, and the files themselves (column file)."""
        audit = audit_headers(self.spark, self.dirty_csv()).checkpoint()
        return read_raw_trips(self.spark, self.dirty_csv(), audit, require_all_columns=False), audit.select("file")


@contextlib.contextmanager
def _small_splits(spark: SparkSession, folder: str) -> Iterator[None]:
    """Scans planned here read a folder's files in about three splits each."""
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path)
    spark.conf.set(key, str(max(1024, found.getLength() // max(1, 3 * found.getFileCount()))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Header variant used for the even months (all accepted spellings of the canonical columns).
VARIANT_HEADERS = [
    ("Hora_Arribo", "Hora_arribo"),
    ("Fecha_Arribo", "Fecha Arribo"),
    ("Ciclo_EstacionArribo", "CE_arribo"),
    ("Hora_Retiro", "Hora_retiro"),
    ("Fecha_Retiro", "Fecha_retiro"),
    ("Ciclo_Estacion_Retiro", "CE_retiro"),
    ("Bici", "Bici"),
    ("Edad_Usuario", " Edad_usuario "),
    ("Genero_Usuario", "Género_usuario"),
]


def _land(rows: DataFrame, out: str, write: Callable[[DataFrameWriter, str], None]) -> None:
    """Rows (source_file, place, ...) as one file ``<out>/<source_file>`` each, in the order of their place."""
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    beside = f"{out}_parts"
    ordered = rows.repartition("source_file").sortWithinPartitions("source_file", "place").drop("place")
    write(ordered.write.mode("overwrite").partitionBy("source_file"), beside)
    folder = jvm.org.apache.hadoop.fs.Path(beside)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(out))
    for part in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{beside}/source_file=*/part-*")):
        name = part.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{out}/{name}"))


def land_trip_csvs(raw: DataFrame, out: str) -> None:
    """Write raw trip rows as monthly CSV files in two header groups (see :meth:`TripStore.csv_database`)."""
    month = F.substring("source_file", 6, 2).cast("int")
    common = {
        "header": True,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    place = ["source_file", F.col("row_key").alias("place")]
    canonical = raw.where(month % 2 == 1).select(*place, *CANONICAL_COLUMNS)
    _land(canonical, out, lambda w, to: w.options(sep=",", encoding="UTF-8", **common).csv(to))
    extra = F.col("row_key").cast("string")
    extra = F.when((month == 2) & (F.col("row_key") % 40 == 0), F.concat(extra, F.lit("\nnote"))).otherwise(extra)
    variant = raw.where(month % 2 == 0).select(*place, *[F.col(src).alias(name) for src, name in VARIANT_HEADERS], extra.alias("Extra"))
    _land(variant, out, lambda w, to: w.options(sep=";", encoding="ISO-8859-1", **common).csv(to))


EMPTY_FILE = "2099-01.csv"


def land_dirty_csvs(raw: DataFrame, out: str) -> None:
    """Monthly files by month % 3, and one with a header alone.

    0: ``,``, rows with two more fields (row_key % 53 = 0), rows of five fields (row_key % 59 = 0);
    1: ``|``, no ``Bici``, two columns more; 2: tabs and a byte order mark.
    """
    kind = F.substring("source_file", 6, 2).cast("int") % 3
    text = {c: F.coalesce(c, F.lit("")) for c in CANONICAL_COLUMNS}
    no_bike = [c for c in CANONICAL_COLUMNS if c != "Bici"]
    row = (
        F.when((kind == 0) & (F.col("row_key") % 53 == 0), F.concat_ws(",", *text.values(), F.lit("more"), F.lit("fields")))
        .when((kind == 0) & (F.col("row_key") % 59 == 0), F.concat_ws(",", *list(text.values())[:5]))
        .when(kind == 0, F.concat_ws(",", *text.values()))
        .when(kind == 1, F.concat_ws("|", *[text[c] for c in no_bike], F.lit("N"), F.lit("x, y")))
        .otherwise(F.concat_ws("\t", *text.values()))
    )
    head = (
        F.when(kind == 0, F.lit(",".join(CANONICAL_COLUMNS)))
        .when(kind == 1, F.lit("|".join([*no_bike, "Zona", "Nota extra"])))
        .otherwise(F.lit("\ufeff" + "\t".join(CANONICAL_COLUMNS)))
    )
    rows = raw.select("source_file", F.col("row_key").alias("place"), row.alias("value"))
    heads = raw.select("source_file").distinct().select("source_file", F.lit(-1).cast("bigint").alias("place"), head.alias("value"))
    empty = raw.sparkSession.createDataFrame([(EMPTY_FILE, -1, ",".join(CANONICAL_COLUMNS))], "source_file string, place bigint, value string")
    _land(rows.unionByName(heads).unionByName(empty), out, lambda w, to: w.text(to))
