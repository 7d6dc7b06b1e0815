"""Row numbers inside each file: distributed methods vs a brute-force sort."""

import random

from pyspark.sql import functions as F

from ridestat.operators.row_index import index_by_key


def test_index_by_key_small_buckets_matches_sort(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(100_000), 3_000)
    # one hot file with a third of the rows, the rest spread over 9 files
    files = ["hot.csv" if i % 3 == 0 else f"f{i % 9}.csv" for i in range(len(keys))]
    df = spark.createDataFrame(list(zip(files, keys)), "source_file string, row_key long").repartition(7)
    got = {(r.source_file, r.row_key): r.row_index for r in index_by_key(df, "source_file", "row_key", bucket_width=97).collect()}
    want = {}
    for f in set(files):
        ks = sorted(k for ff, k in zip(files, keys) if ff == f)
        want.update({(f, k): i for i, k in enumerate(ks)})
    assert got == want


def test_proxy_row_index_is_contiguous(spark):
    from ridestat.sources import proxy

    raw = index_by_key(proxy.raw_trips(spark, "/root/testdata/sf0.001"), "source_file", "row_key", bucket_width=16)
    stats = raw.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_index").alias("lo"), F.max("row_index").alias("hi"),
        F.count_distinct("row_index").alias("d"),
    ).collect()
    assert stats and all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in stats)


def test_bucket_width_follows_key_range(spark):
    from ridestat.operators.row_index import DEFAULT_BUCKET_WIDTH, MAX_BUCKETS_PER_GROUP, bucket_width_for

    small = spark.createDataFrame([(i,) for i in range(1000)], "k long")
    assert bucket_width_for(small, "k") == DEFAULT_BUCKET_WIDTH
    wide = spark.createDataFrame([(0,), (10**13,), (5,)], "k long")
    w = bucket_width_for(wide, "k")
    assert (10**13 + 1) / w <= MAX_BUCKETS_PER_GROUP
    # exact even with very wide buckets
    df = spark.createDataFrame([("a", 0), ("a", 10**13), ("a", 5), ("b", 7)], "source_file string, row_key long")
    got = {(r.source_file, r.row_key): r.row_index for r in index_by_key(df, "source_file", "row_key").collect()}
    assert got == {("a", 0): 0, ("a", 5): 1, ("a", 10**13): 2, ("b", 7): 0}
