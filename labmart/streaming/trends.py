"""Daily measurement trends that follow arriving MEASUREMENT files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

VALUE = "value_as_number"
KEYS = ["measurement_date", "measurement_source_value", "unit_source_value"]
_OBSERVED = "daily_trends"
_DAY = 86400


def trend_stream(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    delay: str = "7 days",
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Keep counts, means and extremes of each day, test and unit up to date.

    ``path`` holds MEASUREMENT files. Rows fall into windows of one day by
    their measurement date; the state store holds the open days, which close
    once the newest date is more than ``delay`` ahead. A row of an open day
    changes that day, a row of a closed one is late: it is left out and
    counted, see ``late_rows``. Each batch writes the days it changed to a
    directory of its own, which a repeated batch overwrites.
    ``current_trends`` reads the latest state of every day.
    """
    schema = spark.read.parquet(path).schema
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        .dropna(subset=KEYS[:2])
        .observe(_OBSERVED, F.count(F.lit(1)).alias("rows"))
        # Midnight UTC, whatever the session's zone.
        .withColumn("event_time", F.timestamp_seconds(F.unix_date("measurement_date") * _DAY))
        .withWatermark("event_time", delay)
    )
    day = F.window("event_time", "1 day").alias("day")
    trends = rows.groupBy(day, *KEYS[1:]).agg(
        F.count(F.lit(1)).alias("daily_test_count"),
        F.count(VALUE).alias("daily_numeric_count"),
        F.avg(VALUE).alias("daily_avg_value"),
        F.min(VALUE).alias("daily_min_value"),
        F.max(VALUE).alias("daily_max_value"),
    )

    def save(batch: DataFrame, epoch: int) -> None:
        number = (F.unix_seconds("day.start") / _DAY).cast("int")
        days = batch.withColumn("measurement_date", F.date_from_unix_date(number)).drop("day")
        days.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")

    return (
        trends.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_trends(spark: SparkSession, target: str) -> DataFrame:
    """The latest state of each day, test and unit that any batch has written."""
    latest = Window.partitionBy(*KEYS).orderBy(F.col("epoch").desc())
    states = spark.read.parquet(target).withColumn("nth", F.row_number().over(latest))
    return states.where("nth = 1").drop("nth", "epoch")


def rows_seen(query: StreamingQuery) -> int:
    """Dated rows with a test that the query's batches have read."""
    seen = (p.observedMetrics.get(_OBSERVED) for p in query.recentProgress)
    return sum(m["rows"] for m in seen if m is not None)


def late_rows(spark: SparkSession, target: str, seen: int) -> int:
    """Of ``seen`` rows, those that came after their day was closed."""
    return seen - (current_trends(spark, target).agg(F.sum("daily_test_count")).first()[0] or 0)
