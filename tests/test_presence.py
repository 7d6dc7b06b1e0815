"""Inputs that are not there: statuses per file, and a named error from each job before any work."""

import pytest

from ridestat.plans import pipeline
from ridestat.sources.presence import MissingInput, input_presence, require_inputs


def _expected(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "file string")


def test_statuses(spark, tmp_path):
    (tmp_path / "2024-01.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2024-02.csv").write_text("")
    (tmp_path / "2024-09.csv").write_text("a\n")
    (tmp_path / "notes.txt").write_text("x")
    out = input_presence(spark, str(tmp_path), _expected(spark, "2024-01.csv", "2024-01.csv", "2024-02.csv", "2024-03.csv", None))
    assert sorted(tuple(r) for r in out.collect()) == [
        ("2024-01.csv", "found", True),
        ("2024-02.csv", "found", False),
        ("2024-03.csv", "missing", False),
        ("2024-09.csv", "unexpected", True),
    ]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert [tuple(r) for r in input_presence(spark, str(empty), _expected(spark, "x.csv")).collect()] == [("x.csv", "missing", False)]
    with pytest.raises(MissingInput, match="nowhere"):
        input_presence(spark, str(tmp_path / "nowhere"), _expected(spark, "x.csv"))


def test_each_missing_input_is_named(spark, tmp_path):
    trips, catalog = tmp_path / "trips", tmp_path / "catalog.csv"
    with pytest.raises(MissingInput, match="trip folder .*trips does not exist"):
        pipeline.build_database(spark, str(trips), str(catalog), str(tmp_path / "db"))
    trips.mkdir()
    with pytest.raises(MissingInput, match="holds no CSV file"):
        pipeline.validate_trip_files(spark, str(trips), str(catalog), str(tmp_path / "out"))
    (trips / "2024-01.csv").write_text("a\n")
    with pytest.raises(MissingInput, match="station catalog .*catalog.csv does not exist"):
        pipeline.missing_station_report(spark, str(trips), str(catalog), str(tmp_path / "out"))
    with pytest.raises(MissingInput, match="trip file .*2024-02.csv does not exist"):
        require_inputs(spark, [str(trips / "2024-01.csv"), str(trips / "2024-02.csv")])
    catalog.write_text("x\n")
    require_inputs(spark, str(trips), str(catalog))
