import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsight.sources import month_table as mt

JAN, FEB, MAR = (dt.date(2025, m, 1) for m in (1, 2, 3))


@pytest.fixture
def frame(spark):
    return lambda rows, schema="month date, v int": spark.createDataFrame(rows, schema)


def rows(spark, path, version=None):
    return sorted(map(str, map(tuple, mt.read_months(spark, path, version).collect())))


def as_text(*expected):
    return sorted(map(str, expected))


def test_new_months_replace_old_ones_and_versions_stay_readable(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    assert mt.upsert_months(frame([(JAN, 1), (FEB, 2), (FEB, 3), (None, 9)]), path) == 1
    assert mt.upsert_months(frame([(FEB, 20), (MAR, 30)]), path) == 2
    assert rows(spark, path) == as_text((JAN, 1), (FEB, 20), (MAR, 30), (None, 9))
    assert rows(spark, path, 1) == as_text((JAN, 1), (FEB, 2), (FEB, 3), (None, 9))
    assert mt.upsert_months(frame([]), path) == 3
    assert mt.upsert_months(frame([(None, 8)]), path) == 4
    assert rows(spark, path) == as_text((JAN, 1), (FEB, 20), (MAR, 30), (None, 8))
    mt.remove_unlisted(spark, path, keep=2)
    assert mt.versions(spark, path) == [3, 4]
    assert rows(spark, path, 3) == as_text((JAN, 1), (FEB, 20), (MAR, 30), (None, 9))


def test_columns_may_come_and_go(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    mt.upsert_months(frame([(JAN, 1)]), path)
    mt.upsert_months(frame([(FEB, "x")], "month date, more string"), path)
    assert rows(spark, path) == as_text((JAN, 1, None), (FEB, None, "x"))
    with pytest.raises(ValueError, match="v was"):
        mt.upsert_months(frame([(FEB, "x")], "month date, v string"), path)


def test_a_failed_write_changes_nothing(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    mt.upsert_months(frame([(JAN, 1), (FEB, 2)]), path)
    bad = frame([(FEB, 5), (MAR, 6)]).withColumn(
        "v", F.when(F.col("v") == 6, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        mt.upsert_months(bad, path)
    assert mt.versions(spark, path) == [1] and rows(spark, path) == as_text((JAN, 1), (FEB, 2))
    mt.upsert_months(frame([(FEB, 7)]), path)
    assert rows(spark, path) == as_text((JAN, 1), (FEB, 7))


def test_the_second_of_two_writers_is_told(spark, tmp_path, frame, monkeypatch):
    path = str(tmp_path / "t")
    mt.upsert_months(frame([(JAN, 1)]), path)
    first_seen = mt.versions
    monkeypatch.setattr(mt, "versions", lambda *_: [1])  # read before the other one switched
    mt.upsert_months(frame([(FEB, 2)]), path)
    with pytest.raises(mt.ConcurrentUpsert):
        mt.upsert_months(frame([(FEB, 99)]), path)
    monkeypatch.setattr(mt, "versions", first_seen)
    assert rows(spark, path) == as_text((JAN, 1), (FEB, 2)) and mt.versions(spark, path) == [1, 2]


def test_a_table_must_be_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        mt.read_months(spark, str(tmp_path / "none"))
