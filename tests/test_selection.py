"""Ordered integers and radix selection against sorting."""

import math
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labmart.operators.gold import (
    grouped_percentiles,
    laboratory_analytics,
    measurement_trends,
    patient_summary,
)
from labmart.operators.selection import ordered_integer

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
         math.inf, -math.inf, math.nan, 1.0, 1 - 2**-53, 1 + 2**-52, 2.0**1023, 2.0**1023 * (2 - 2**-52), 1e9, 1e9 + 2**-23]
EDGES += [math.nextafter(2.0**k, x) for k in range(-1074, 1024, 61) for x in (0, math.inf)] + [2.0**k for k in range(-1074, 1024, 61)]


def bits(x):
    """The IEEE bits as a signed integer in order; NaN last, zeros equal."""
    if math.isnan(x):
        return 1 << 63
    n = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(width=64), min_size=1, max_size=60))
def test_integers_keep_the_order(spark, values):
    values = EDGES + [-x for x in EDGES] + values
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for r in df.select("x", ordered_integer(F.col("x")).alias("i")).collect():
        assert r.i == 2047 * 2**52 + 1 if math.isnan(r.x) else r.i == bits(r.x)


def nearest(values, p):
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("listed", [1, 40, 65536])
def test_close_values_by_radix(spark, listed):
    """Values within 0.2 % of each other, far ones, ties and a hot group, with cells of few values."""
    i = F.col("id")
    df = spark.range(0, 9000, numPartitions=6).select(
        F.when(i % 2 == 0, "close").when(i % 5 == 0, "few").otherwise("wide").alias("k"),
        F.when(i % 2 == 0, 37.0 + (i * 7919 % 9000) * 0.074 / 9000)
        .when(i % 5 == 0, (i % 3).cast("double")).otherwise(F.exp((i % 4001) / 7.0) * (i % 3 - 1)).alias("value_as_number"),
    )
    at = {"a": 0.025, "q": 0.25, "m": 0.5, "z": 0.975, "hi": 1.0, "lo": 0.0}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r.value_as_number)
    found = grouped_percentiles(df, ["k"], at, listed)
    rows = {r.k: r for r in found.collect()}
    assert set(rows) == set(groups)
    for k, own in groups.items():
        own.sort()
        for name, p in at.items():
            assert rows[k][name] == pytest.approx(nearest(own, p), rel=1e-12, abs=1e-300)


def _measurement(spark, tmp_path, n=4000):
    i = F.col("id")
    spark.range(0, n, numPartitions=4).select(
        (i % 37).alias("person_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (i % 3).cast("int")).alias("measurement_date"),
        F.concat(F.lit("T"), (i % 2).cast("string")).alias("measurement_source_value"),
        F.lit("mg/dL").alias("unit_source_value"), F.lit(8840).alias("unit_concept_id"),
        (1e9 + (i * 31 % 1000) / 1000.0).alias("value_as_number"), F.lit(None).cast("string").alias("value_source_value"),
        F.lit(0).alias("measurement_event_id"), F.lit(2020).alias("measurement_year"), F.lit(1).alias("measurement_month"),
    ).write.parquet(f"{tmp_path}/m")
    return spark.read.parquet(f"{tmp_path}/m")


def test_two_scans_and_stable_deviation(spark, tmp_path):
    rows = _measurement(spark, tmp_path)
    values = [1e9 + (i * 31 % 1000) / 1000.0 for i in range(4000)]
    for build, name in ((patient_summary, "stddev_numeric_value"), (measurement_trends, "daily_stddev_value"), (laboratory_analytics, "stddev_numeric_result")):
        result = build(rows)
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        # The tallied items are read from the shared folder, not from the table again.
        direct = sum("Relation" in line and "value_source_value" in line for line in plan.splitlines())
        assert direct <= (2 if build is patient_summary else 1)
        assert all(r[name] > 0.2 for r in result.collect())
    import statistics

    for r in laboratory_analytics(rows).collect():
        own = [v for i, v in enumerate(values) if f"T{i % 2}" == r.lab_test_code]
        assert r.stddev_numeric_result == pytest.approx(statistics.stdev([v - 1e9 for v in own]), rel=1e-6)
        assert r.median_numeric_result == pytest.approx(statistics.median(own), rel=1e-15)


def test_stored_items_can_be_released(spark, tmp_path):
    import os

    from labmart import session

    measurement_trends(_measurement(spark, tmp_path, 40)).collect()
    name = session._stores[spark.sparkContext.applicationId][1]
    place = spark.sql(f"DESCRIBE DATABASE {name}").where("info_name = 'Location'").first()[1].removeprefix("file:")
    assert os.listdir(place)
    session.release()
    assert not os.path.exists(place)
