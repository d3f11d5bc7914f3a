"""Steps whose memory must not grow with the rows of a task."""

from pyspark.sql import functions as F

from labmart.operators import selection
from labmart.session import sql_settings
from registry import adapter as at


def _tables(spark, path):
    """Orders 1 (twice), 2 and one without a key; line items of orders 1, 2, 3 and of none."""
    orders = "o_orderkey bigint, o_custkey bigint, o_orderdate date"
    spark.sql(
        "SELECT * FROM VALUES (1L, 10L, DATE'1995-01-02'), (1L, 11L, DATE'1995-01-02'), "
        "(2L, 12L, DATE'1996-03-04'), (NULL, 13L, DATE'1996-03-04') AS t(o_orderkey, o_custkey, o_orderdate)"
    ).to(_schema(spark, orders)).write.parquet(f"{path}/orders.parquet")
    lines = spark.sql("SELECT explode(array(1L, 2L, 3L, NULL)) AS l_orderkey")
    lines.select(
        "l_orderkey", F.lit(2).alias("l_linenumber"), F.lit(21).cast("bigint").alias("l_partkey"),
        F.lit(5).cast("bigint").alias("l_suppkey"), F.lit(7.5).alias("l_quantity"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.to_date(F.lit("1996-05-06")).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _schema(spark, text):
    return spark.createDataFrame([], text).schema


def test_line_items_meet_their_orders_unsorted(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    with sql_settings(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        rows = at.lab_results(spark, sf)
        found = sorted((r.visit_id, r.patient_id) for r in rows.collect())
        plan = rows._jdf.queryExecution().toString()
    assert found == [("1", "10"), ("1", "11"), ("2", "12")]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_tallying_task_reads_a_small_split(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(0, 1200, 1, 12).selectExpr("id % 3 AS k", "id % 7 AS item", "CAST(id AS double) AS v").write.parquet(path)
    tasks = []

    def stored(df, label):
        # Tasks of the scan: the exchange is after it, so the tally's own plan is not asked.
        tasks.append(rows.rdd.getNumPartitions())
        return kept(df, label)

    kept = selection.store
    monkeypatch.setattr(selection, "store", stored)
    with sql_settings(spark, files__minPartitionNum="1"):
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() == 1
        rows = spark.read.parquet(path)
        found = selection.tally(rows, ["k"], F.col("v"), [F.col("item")])
        counted = {(r["k"], r["t"]): r["n"] for r in found.groupBy("k", F.col(selection.TAG).alias("t")).count().withColumnRenamed("count", "n").collect()}
    assert tasks[0] > 1
    assert counted == {(k, t): n for k in range(3) for t, n in ((0, 400), (1, 7))}


def test_files_to_load_go_once_loaded(spark, tmp_path, monkeypatch):
    sf, folder = _tables(spark, tmp_path / "sf"), tmp_path / "scratch"
    monkeypatch.setattr(at, "new_scratch_path", lambda spark, label: f"{folder}/{label}")
    loaded = at.stored_loaded(spark, sf)
    assert list(folder.rglob("*.parquet")) and not list(folder.rglob("*.csv*"))
    staged = at.lab_csv(spark, sf)
    with at._files_to_load(spark, sf) as used:
        assert used == staged
    assert list(folder.rglob("*.csv"))
    assert sorted((str(r.visit_id), r.patient_id, r.source_file) for r in loaded.collect()) == [
        ("1", "10", "1995"), ("1", "11", "1995"), ("2", "12", "1996")
    ]


def test_clustered_rows_are_exchanged_before_they_are_typed(spark, tmp_path, monkeypatch):
    from labmart.sinks import tables

    sf, seen, spread = _tables(spark, tmp_path), [], tables.spread_and_sort

    def noted(*args, **kwargs):
        seen.append(spread(*args, **kwargs))
        return seen[-1]

    monkeypatch.setattr(tables, "spread_and_sort", noted)
    found = at.stored_bronze(spark, sf)
    plain = at.bronze(spark, sf, partition_columns=True)
    assert sorted(map(str, found.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    exchanged = plan[plan.index("RepartitionByExpression"):].split("\n")[1]
    assert "LC:" not in exchanged and "LC:" in plan  # the text of a test is made after the exchange
    assert seen[0].columns == plain.columns


def test_derived_rows_lie_in_ranges_of_their_keys(spark, tmp_path):
    from labmart.operators.rowid import spread_and_sort

    path = str(tmp_path / "rows")
    spark.range(0, 4000, 1, 7).selectExpr("IF(id % 50 = 0, NULL, id * 37 % 1000) AS v", "id").write.parquet(path)
    key = -F.col("v")
    placed = spread_and_sort(
        spark.read.parquet(path), ["k"], 6,
        lambda rows, kept: rows.select(key.alias("k"), "id", *kept), [key],
    )
    parts = placed.rdd.glom().map(lambda rows: [(r.k is None, r.k or 0) for r in rows]).collect()
    assert placed.columns == ["k", "id"] and sum(map(len, parts)) == 4000 and len(parts) == 6
    flat = [k for part in parts for k in part]
    assert flat == sorted(flat)
    assert sorted(r.id for r in placed.collect()) == list(range(4000))
