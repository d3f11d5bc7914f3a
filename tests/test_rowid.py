"""Row numbers over files that hold duplicates and hot keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labmart.operators.rowid import global_row_id, spread_and_sort

KEYS = ["t", "p"]


def stored(spark, tmp_path):
    """A third of the rows are copies of one row, a third lack the first key."""
    n = F.col("id")
    rows = spark.range(0, 9000, numPartitions=6).select(
        F.when(n % 3 == 0, 5).when(n % 3 == 1, None).otherwise(n % 100).alias("t"),
        F.when(n % 3 == 0, "same").otherwise((n % 50).cast("string")).alias("p"),
        F.when(n % 3 == 0, 1).otherwise(n).alias("x"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def test_numbers_equal_the_window(spark, tmp_path):
    df = stored(spark, tmp_path)
    numbered = global_row_id(df, KEYS, "row_id", partitions=5)
    order = Window.orderBy(*[F.col(k).asc_nulls_last() for k in KEYS])
    wanted = df.withColumn("row_id", F.row_number().over(order))
    assert numbered.columns == [*df.columns, "row_id"]
    ours = numbered.select("row_id", *KEYS)
    assert ours.exceptAll(wanted.select("row_id", *KEYS)).isEmpty()
    assert ours.count() == 9000
    assert numbered.select(*df.columns).exceptAll(df).isEmpty()
    again = global_row_id(df, KEYS, "row_id", partitions=7)
    assert numbered.exceptAll(again).isEmpty()


def test_several_files_per_task(spark, tmp_path):
    df = stored(spark, tmp_path)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 700)
    try:
        numbered = global_row_id(df, KEYS, partitions=3)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    bounds = numbered.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first()
    assert tuple(bounds) == (1, 9000, 9000)
    in_order = numbered.orderBy("row_id").select("t", "p").collect()
    assert in_order == sorted(in_order, key=lambda r: (r.t is None, r.t, r.p))


def test_wide_rows_are_not_exchanged(spark, tmp_path):
    """The rows themselves meet their numbers by bucket: an exchange carries keys, locators or numbers only."""
    wide = stored(spark, tmp_path).withColumns({f"c{i}": F.concat(F.lit(f"{i}"), F.col("p")) for i in range(30)})
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.debug.maxToStringFields": "200"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        numbered = global_row_id(wide, KEYS)
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "c29" in x)
    join = max(i for i in range(scan) if "Join" in lines[i])
    assert not any("Exchange" in x for x in lines[join:scan])
    assert not any("Exchange" in x and "c29" in x for x in lines)
    assert numbered.count() == 9000


def test_copies_spread_over_partitions(spark, tmp_path):
    placed = spread_and_sort(stored(spark, tmp_path), KEYS, partitions=9)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 2500
    hot = placed.filter("p = 'same'").select(F.spark_partition_id().alias("i")).distinct()
    assert hot.count() >= 3


def test_wide_rows_are_stored_without_a_sort(spark, tmp_path, monkeypatch):
    """The write by buckets keeps files open, as a sort by bucket would spill a large task's rows."""
    from pyspark.sql import DataFrameWriter

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen, write = spark.conf.get(setting, "0"), {}, DataFrameWriter.saveAsTable

    def noted(self, name, *args, **kwargs):
        seen[name.split(".")[1].split("_")[0]] = spark.conf.get(setting, "0")
        return write(self, name, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", noted)
    numbered = global_row_id(stored(spark, tmp_path), KEYS, "row_id", partitions=5)
    assert seen == {"located": "64", "order": before} and spark.conf.get(setting, "0") == before
    assert numbered.select("row_id").distinct().count() == numbered.count() == 9000
