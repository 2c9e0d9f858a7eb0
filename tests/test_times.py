"""Results do not depend on the session's time zone, also not in its gaps."""

import pytest
from pyspark.sql import functions as F

from recspark.functions import ids, times, values
from recspark.operators import commits, versions

TEXTS = {
    "2024-03-10T02:30:00": "2024-03-10T02:30:00Z", "2024-03-10 02:30:00Z": "2024-03-10T02:30:00Z", "2024-03-10T02:30:00.120+02:00": "2024-03-10T00:30:00.12Z",
    "2024-11-03T01:30:00-0500": "2024-11-03T06:30:00Z", "2024-03-10": "2024-03-10T00:00:00Z", "2024-03-10T02:30": "2024-03-10T02:30:00Z",
    "1969-12-31T23:59:59.999999": "1969-12-31T23:59:59.999999Z", "0001-01-01T00:00:00Z": "0001-01-01T00:00:00Z", "no time": None, None: None,
}


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kathmandu"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_texts(spark, zone):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: (r.iso, r.m) for r in df.select("t", ids.iso_format(ids.iso_parse(F.col("t"))).alias("iso"), values.date_time_magnitude(F.col("t")).alias("m")).collect()}
    assert {t: iso for t, (iso, _) in got.items()} == TEXTS
    assert got["0001-01-01T00:00:00Z"][1] == 0 and got["no time"][1] is None
    assert got["2024-03-10T02:30:00"][1] == got["2024-03-10 02:30:00Z"][1] == got["2024-03-10T02:30"][1]


def test_micros_there_and_back(spark, zone):
    df = spark.range(-40, 40).select((F.col("id") * 86_399_999_999_977).alias("m"))
    back = df.select("m", times.micros_of_ntz(times.ntz_of_micros(F.col("m"))).alias("b"), times.micros(times.of_micros(F.col("m"), _kind("timestamp")), _kind("timestamp")).alias("c"))
    assert all(r.m == r.b == r.c for r in back.collect())


def _kind(name):
    from pyspark.sql import types as T

    return T.TimestampType() if name == "timestamp" else T.TimestampNTZType()


def test_strict_times_in_a_gap(spark, zone):
    """02:30 does not exist in New York on that day."""
    df = spark.createDataFrame([(1, 1, "2024-03-10 02:30:00"), (1, 2, "2024-03-10 02:30:00"), (1, 3, "2024-03-10 02:29:00"), (1, 4, "2024-03-10 03:30:00")], "vo_id long, sys_version int, t string")
    out = versions.strict_times(df.withColumn("sys_period_lower", F.col("t").cast("timestamp_ntz")))
    got = [r.s for r in out.orderBy("sys_version").select(F.col("sys_period_lower").cast("string").alias("s")).collect()]
    assert got == ["2024-03-10 02:30:00", "2024-03-10 02:30:00.000001", "2024-03-10 02:30:00.000002", "2024-03-10 03:30:00"]


def test_commits_in_a_gap(spark, zone):
    head = spark.createDataFrame([(1, 1, 1)], "vo_id long, ehr_id long, sys_version int").withColumn("sys_period_lower", F.lit("2024-03-10 02:15:00").cast("timestamp_ntz"))
    history = head.limit(0).withColumns({"sys_period_upper": F.lit(None).cast("timestamp_ntz"), "sys_deleted": F.lit(False)})
    changes = spark.createDataFrame([(7, 1, 1, "modification", 1), (8, 1, 1, "modification", 2)], "change_id long, vo_id long, ehr_id long, change_type string, preceding_version int")
    done = commits.apply_commits(head, history, changes.withColumn("committed_at", F.lit("2024-03-10 02:15:00").cast("timestamp_ntz")))
    assert [r.s for r in done.head.select(F.col("sys_period_lower").cast("string").alias("s")).collect()] == ["2024-03-10 02:15:00.000002"]
