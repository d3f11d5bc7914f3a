"""Daily trends of a stream: rows in time, late rows, restarts."""

import datetime as dt

from labmart.operators.gold import measurement_trends
from labmart.streaming import current_trends, late_rows, rows_seen, trend_stream

SCHEMA = (
    "person_id bigint, measurement_date date, measurement_source_value string, unit_source_value string, "
    "unit_concept_id int, value_as_number double, value_source_value string, measurement_event_id int, "
    "measurement_year int, measurement_month int"
)


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def put(spark, path, *rows):
    full = [(1, day(n), test, unit, 0, value, None, 0, 2020, 1) if n is not None else (1, None, test, unit, 0, value, None, 0, 2020, 1) for n, test, unit, value in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, folder):
    query = trend_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", delay="3 days")
    query.awaitTermination()
    return rows_seen(query)


def test_days_change_until_they_close(spark, tmp_path):
    folder = str(tmp_path)
    put(spark, f"{folder}/in", (0, "A", "g", 1.0), (0, "A", "g", 3.0), (1, "A", None, None), (None, "A", "g", 9.0), (2, None, "g", 9.0))
    seen = run(spark, folder)
    put(spark, f"{folder}/in", (0, "A", "g", 8.0), (10, "B", "g", 4.0))
    seen += run(spark, folder)
    # Day 0 is still open for the second batch; after it, days before 7 are closed.
    on_time = measurement_trends(spark.read.parquet(f"{folder}/in")).collect()
    put(spark, f"{folder}/in", (0, "A", "g", 100.0), (0, "A", "g", 101.0), (9, "B", "g", 5.0))
    seen += run(spark, folder)
    found = {(r.measurement_date, r.measurement_source_value, r.unit_source_value): r for r in current_trends(spark, f"{folder}/out").collect()}
    assert seen == 8 and late_rows(spark, f"{folder}/out", seen) == 2
    assert len(found) == 4 and found[day(9), "B", "g"].daily_avg_value == 5.0
    for want in on_time:
        got = found[want.measurement_date, want.measurement_source_value, want.unit_source_value]
        for c in ("daily_test_count", "daily_avg_value", "daily_min_value", "daily_max_value"):
            assert got[c] == want[c]
    assert run(spark, folder) == 0 and current_trends(spark, f"{folder}/out").count() == 4


def test_stream_input_grows_in_files(spark, tmp_path, monkeypatch):
    """More rows give more files, not larger ones, still read in three batches."""
    from registry import adapter, queries

    made = []

    def stream(spark, path, target, checkpoint, files_per_batch, **options):
        made.append((len(spark.read.parquet(path).inputFiles()), files_per_batch))
        return trend_stream(spark, path, target, checkpoint, files_per_batch=files_per_batch, **options)

    monkeypatch.setattr(queries, "trend_stream", stream)
    monkeypatch.setattr(adapter, "RANGE_ROWS", 400)
    number = "id l_orderkey, id l_partkey, id l_suppkey, int(id % 7) + 1 l_linenumber, double(id) l_quantity"
    day = "timestamp'1995-01-01' + make_interval(0, 0, 0, int(id % 50))"
    lines = spark.range(6000).selectExpr(*number.split(", "), "'A' l_returnflag", "'F' l_linestatus", f"{day} l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.range(6000).selectExpr("id o_orderkey", "id % 90 o_custkey", f"{day} o_orderdate")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    found = queries.QUERIES["trend_stream"](spark, str(tmp_path))
    assert made == [(15, 5)]
    assert found.count() == found.select("measurement_date", "measurement_source_value", "unit_source_value").distinct().count()
