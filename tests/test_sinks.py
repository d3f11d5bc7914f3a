"""Tables on disk: layout, guards, quarantine, publishing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from labmart.mappings import SEED_CONCEPTS
from labmart.operators.access import time_range
from labmart.operators.audits import LoadAudit, bronze_stats
from labmart.operators.bronze import bronze_typed
from labmart.operators.silver import omop_measurement
from labmart.operators.vocabulary import seed_concepts
from labmart.plans import bronze_to_silver, csv_to_bronze, load_vocabularies, silver_to_gold
from labmart.plans import flows
from labmart.schemas import LAB_27
from labmart.sinks import (
    PublishError,
    accepted,
    append_with_quarantine,
    insert_missing,
    quarantined,
    run_name,
    seed_if_empty,
    staged_publish,
    vocabulary_needed,
    with_bucket_column,
    write_table,
)
from tests.rows import raw


def lab(spark, n=3000):
    """Two thirds of the rows fall into one month and a third belongs to one patient."""
    i = F.col("id")
    return spark.range(0, n, numPartitions=6).select(
        F.when(i % 3 == 0, 1900).otherwise(2020 + i % 2).cast("int").alias("year"),
        F.when(i % 3 == 0, 1).otherwise(1 + i % 12).cast("int").alias("month"),
        F.when(i % 3 == 1, "hot").otherwise((i % 200).cast("string")).alias("patient_id"),
        (i % 7).cast("string").alias("code"),
        i.alias("x"),
    )


def test_clustered_files_hold_disjoint_ranges(spark, tmp_path):
    path = write_table(
        lab(spark),
        path=str(tmp_path / "t"),
        partition_by=["year", "month"],
        cluster_by=["patient_id", "code"],
        partitions=8,
    )
    table = spark.read.parquet(path)
    assert table.count() == 3000 and table.select("x").distinct().count() == 3000
    files = (
        table.groupBy("year", "month", F.col("_metadata.file_name").alias("f"))
        .agg(F.min("patient_id").alias("lo"), F.max("patient_id").alias("hi"))
        .collect()
    )
    hot = sorted((r.lo, r.hi) for r in files if (r.year, r.month) == (1900, 1))
    assert len(hot) > 1
    assert all(a[1] <= b[0] for a, b in zip(hot, hot[1:]))


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    rows = lab(spark).withColumn(
        "sampling_datetime_utc", F.make_timestamp_ntz("year", "month", F.lit(2), F.lit(0), F.lit(0), F.lit(0))
    )
    path = write_table(rows, path=str(tmp_path / "t"), partition_by=["year", "month"])
    table = spark.read.parquet(path)
    found = time_range(table, dt.date(2020, 6, 1), dt.date(2021, 3, 31))
    low, high = dt.datetime(2020, 6, 1), dt.datetime(2021, 3, 31)
    wanted = [r for r in rows.collect() if low <= r.sampling_datetime_utc <= high]
    assert found.count() == len(wanted) > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and "month" in filters
    late = spark.createDataFrame(
        [(1999, 12, dt.datetime(1999, 12, 30), dt.datetime(2000, 1, 2))],
        "year int, month int, sampling_datetime_utc timestamp_ntz, result_datetime_utc timestamp_ntz",
    )
    assert time_range(late, dt.date(2000, 1, 1)).count() == 0
    assert time_range(late, dt.date(2000, 1, 1), c="result_datetime_utc").count() == 1


def test_bucketed_table(spark, database):
    rows = spark.range(500).select(F.col("id").alias("concept_id"), F.lit("v").alias("vocabulary_id"))
    name = f"{database}.{run_name('concept')}"
    write_table(rows, name, bucket_by=(16, "concept_id"), sort_by=["vocabulary_id"])
    assert spark.table(name).count() == 500
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "16"
    joined = spark.table(name).join(spark.table(name).alias("b"), "concept_id")
    assert joined.count() == 500
    bucketed = with_bucket_column(rows, "concept_id", 4)
    assert {r[0] for r in bucketed.select("concept_id_bucket").distinct().collect()} == {0, 1, 2, 3}


def test_overwrite_replaces_all_partitions(spark, database):
    name = f"{database}.t"
    write_table(lab(spark), name, partition_by=["year", "month"])
    with pytest.raises(Exception):
        write_table(lab(spark), name, partition_by=["year", "month"])
    write_table(lab(spark).filter("year = 2020"), name, partition_by=["year", "month"], mode="overwrite")
    assert {r[0] for r in spark.table(name).select("year").distinct().collect()} == {2020}


def test_quarantine_keeps_every_row(spark, tmp_path):
    path = str(tmp_path / "q")
    rows = raw(
        spark,
        {},
        {"value_as_number": "abc"},
        {"value_as_number": "x", "visit_id": "y"},
        {"value_as_number": "", "report_date_utc": None},
        {"patient_id": "nan"},
        {"patient_id": None},
        {"patient_id": "", "value_as_number": "y"},
    )
    append_with_quarantine(rows, path, "b1")
    assert accepted(spark, path).count() + quarantined(spark, path).count() == rows.count()
    append_with_quarantine(rows.limit(1), path, "b2")
    assert accepted(spark, path).count() == 3
    bad = {r.reject_reason: json.loads(r.raw_record) for r in quarantined(spark, path).collect()}
    assert set(bad) == {
        "value_as_number", "visit_id,value_as_number", "patient_id", "value_as_number,patient_id"
    }
    assert bad["value_as_number"]["value_as_number"] == "abc"
    clean = str(tmp_path / "clean")
    append_with_quarantine(raw(spark, {}), clean, "b")
    assert quarantined(spark, clean).count() == 0


def test_seed_and_insert_once(spark, database):
    name = f"{database}.concept"
    write_table(seed_concepts(spark).limit(0), name)
    assert seed_if_empty(spark, name, seed_concepts(spark))
    assert not seed_if_empty(spark, name, seed_concepts(spark))
    insert_missing(spark, name, seed_concepts(spark))
    assert spark.table(name).count() == len(SEED_CONCEPTS)
    assert vocabulary_needed(spark, database)
    write_table(spark.range(1), f"{database}.vocabulary")
    write_table(spark.range(1), f"{database}.concept_relationship")
    assert vocabulary_needed(spark, database)
    assert not vocabulary_needed(spark, database, enough_concepts=4)
    assert vocabulary_needed(spark, database, enough_concepts=5)


def test_failed_publish_changes_nothing(spark, database):
    old = spark.range(3)
    staged_publish(spark, database, {"a": old, "b": old})
    with pytest.raises(PublishError) as failure:
        staged_publish(
            spark,
            database,
            {"a": spark.range(5), "b": spark.range(0)},
            checks={"b": lambda df: ["empty"] if df.isEmpty() else []},
        )
    assert ("check", "a", "ok") in failure.value.log.events
    assert spark.table(f"{database}.a").count() == spark.table(f"{database}.b").count() == 3
    staged_publish(spark, database, {"a": spark.range(5)})
    assert spark.table(f"{database}.a").count() == 5
    assert sorted(t.name for t in spark.catalog.listTables(database)) == ["a", "b"]


def test_vocabulary_flow_rejects_duplicates(spark, database, tmp_path):
    def put(name, *lines):
        (tmp_path / name).write_text("\n".join("\t".join(line) for line in lines) + "\n")

    vocab = ["vocabulary_id", "vocabulary_name", "vocabulary_reference", "vocabulary_version", "vocabulary_concept_id"]
    concept = "concept_id concept_name domain_id vocabulary_id concept_class_id standard_concept concept_code valid_start_date valid_end_date invalid_reason".split()
    relation = "concept_id_1 concept_id_2 relationship_id valid_start_date valid_end_date invalid_reason".split()
    put("VOCABULARY.csv", vocab, ["V1", "one", "", "", "1"], ["V1", "again", "", "", "x"])
    put("CONCEPT.csv", concept, ["1", "n", "d", "V1", "c", "S", "k", "19700101", "20991231", ""], ["abc", *["q"] * 9])
    put("CONCEPT_RELATIONSHIP.csv", relation, ["1", "1", "Is a", "1970-01-01", "20991231", ""])
    put("DOMAIN.csv", ["domain_id", "domain_name", "domain_concept_id"], ["D", "name", "1"], ["", "no id", "2"])
    with pytest.raises(PublishError, match="unique_ids"):
        load_vocabularies(spark, str(tmp_path), database, min_concepts=1)
    assert spark.catalog.listTables(database) == []
    put("VOCABULARY.csv", vocab, ["V1", "one", "", "", "1"], ["  ", "blank", "", "", "1"])
    with pytest.raises(PublishError, match="expected at least 2"):
        load_vocabularies(spark, str(tmp_path), database, min_concepts=2)
    load_vocabularies(spark, str(tmp_path), database, min_concepts=1)
    assert spark.table(f"{database}.vocabulary").count() == 1
    assert spark.table(f"{database}.domain").count() == 1
    row = spark.table(f"{database}.concept").first()
    assert row.valid_start_date == dt.date(1970, 1, 1) and row.concept_id == 1


def test_silver_moves_undated_rows_only(spark, database, monkeypatch):
    rows = bronze_typed(
        raw(
            spark,
            *[{"patient_id": str(i), "sampling_datetime_utc": f"20{10 + i % 3}-0{1 + i % 9}-02 00:00:00"} for i in range(40)],
            *[{"patient_id": str(i), "sampling_datetime_utc": None, "result_datetime_utc": f"2015-0{1 + i % 9}-03 00:00:00"} for i in range(20)],
            {"sampling_datetime_utc": "1900-01-05 00:00:00"},
        ),
        "b",
        partition_columns=True,
    )
    write_table(rows, f"{database}.bronze", partition_by=["year", "month"])
    written = []
    monkeypatch.setattr(flows, "write_table", lambda df, *a, **k: written.append(df) or write_table(df, *a, **k))
    silver = spark.table(bronze_to_silver(spark, f"{database}.bronze", f"{database}.silver", as_of=dt.date(2024, 1, 1)))
    want = omop_measurement(rows, None, dt.date(2024, 1, 1))
    assert silver.select(want.columns).exceptAll(want).isEmpty() and silver.count() == want.count() == 61
    # One exchange, below it the one partition of rows without a time.
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Rebalance") == 1
    part = plan[plan.index("Rebalance"):]
    assert "(year#" in part and "= 1900" in part
    assert silver.where("measurement_year = 2015").count() == 20


def test_layers_end_to_end(spark, database, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    records = raw(
        spark,
        *[{"patient_id": str(i % 9), "measurement_source_value": f"LC:{i % 4}"} for i in range(60)],
        {"patient_id": "P1"},
        {"sampling_datetime_utc": ""},
    ).collect()
    lines = [",".join(LAB_27)] + [",".join(v or "" for v in r) for r in records]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    seen, mapped = LoadAudit(), LoadAudit()
    with pytest.raises(LookupError):
        seen.frame(spark)
    bronze = csv_to_bronze(spark, str(folder), f"{database}.bronze", "b", run_id="r1", audit=seen)
    counted = bronze_stats(spark.table(bronze)).first().asDict()
    found = seen.frame(spark).first().asDict()
    assert found["sentinel_rows"] == 1 and found.items() & counted.items() >= {("total_records", 62)}
    assert all(found[k] == v for k, v in counted.items() if k in found)
    assert bronze == f"{database}.bronze_r1" and spark.table(bronze).count() == 62
    silver = bronze_to_silver(spark, bronze, f"{database}.measurement", as_of=dt.date(2024, 1, 1), audit=mapped)
    assert spark.table(silver).count() == 61 == mapped.frame(spark).first().total_measurements
    gold = silver_to_gold(spark, silver, database, min_count=1)
    summary = spark.table(gold["patient_summary"])
    assert summary.agg(F.sum("total_measurements")).first()[0] == 61
    trends = spark.table(gold["measurement_trends"])
    assert trends.agg(F.sum("daily_test_count")).first()[0] == 61
    analytics = spark.table(gold["laboratory_analytics"])
    assert analytics.agg(F.sum("total_test_count")).first()[0] == 61
    direct = bronze_typed(raw(spark, {}), "b")
    assert set(direct.columns) <= set(spark.table(bronze).columns)


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path, monkeypatch):
    """Rows of many partitions are written as they come; the session is as it was afterwards."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F

    from registry import adapter

    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, seen = spark.conf.get(setting, "0"), []
    for method in ("save", "csv"):
        def noted(self, *args, _write=getattr(DataFrameWriter, method), **kwargs):
            seen.append(spark.conf.get(setting, "0"))
            return _write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, method, noted)
    rows = spark.range(2000).select("id", (F.col("id") % 80).cast("string").alias("source"))
    write_table(rows, path=f"{tmp_path}/table", partition_by=["source"])
    monkeypatch.setattr(adapter, "lab_results", lambda *args, **kwargs: rows)
    text = spark.read.option("header", "true").csv(adapter.lab_csv(spark, str(tmp_path)))
    assert seen == ["64", "64"] and spark.conf.get(setting, "0") == before
    for found in (spark.read.parquet(f"{tmp_path}/table"), text):
        assert found.selectExpr("int(id)", "source").distinct().count() == found.count() == 2000
