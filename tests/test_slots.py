"""Concept joins over tables that are bucketed by slots of the code."""

from pyspark.sql import functions as F

from labmart.operators.concepts import concept_lookup, slot_lookup, write_by_code


def test_no_exchange_and_frequent_codes_split(spark, database):
    i = F.col("id")
    rows = spark.range(6000).select(
        F.when(i % 3 == 0, "hot").when(i % 3 == 1, F.concat(F.lit("c"), (i % 40).cast("string"))).alias("measurement_source_value"),
        i.alias("x"),
    )
    concept = spark.createDataFrame(
        [("hot", 1, "a"), ("hot", 2, "b"), *[(f"c{n}", 10 + n, "a") for n in range(0, 40, 2)], (None, 99, "a"), ("unused", 98, "a")],
        "concept_code string, concept_id int, vocabulary_id string",
    )
    names = write_by_code(rows, concept, f"{database}.r", f"{database}.c", buckets=8, rows_per_slot=100)
    fact, side = (spark.table(n) for n in names)
    limits = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        joined = slot_lookup(fact, side)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = concept_lookup(rows, concept)
        assert set(joined.columns) == set(want.columns)
        assert joined.select(*want.columns).exceptAll(want).isEmpty() and joined.count() == want.count()
    finally:
        for k, v in limits.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # 2,000 rows of one code lie in 20 slots and so in several buckets.
    hot = fact.where("measurement_source_value = 'hot'")
    assert hot.select("code_slot").distinct().count() == 20
    assert hot.select(F.col("_metadata.file_name")).distinct().count() >= 6
    assert fact.where("measurement_source_value IS NULL").count() == 2000
