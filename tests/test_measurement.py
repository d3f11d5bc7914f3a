"""Silver, concepts, gold and audits against hand-made rows and brute force."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labmart.operators import audits
from labmart.operators.bronze import bronze_typed
from labmart.operators.concepts import concept_backfill, concept_lookup
from labmart.operators.gold import (
    datamart_lab_stats,
    datamart_patient_stats,
    grouped_percentiles,
    laboratory_analytics,
    measurement_trends,
    patient_summary,
)
from labmart.operators.silver import omop_measurement
from tests.rows import raw

AS_OF = dt.date(2020, 1, 1)


def silver(spark, *changes):
    return omop_measurement(bronze_typed(raw(spark, *changes), "b"), as_of=AS_OF)


def test_rows_fit_for_omop(spark):
    bad = [
        {"patient_id": p} for p in (None, "", "  ", "nan", "P12")
    ] + [{"measurement_source_value": c} for c in (None, "", "  ")]
    assert silver(spark, *bad).count() == 0
    row = silver(spark, {}).first()
    assert len(row) == 24
    assert (row.person_id, row.provider_id, row.visit_occurrence_id) == (12, 55, 7)
    assert (row.measurement_year, row.measurement_month) == (2023, 2)
    assert row.measurement_datetime == dt.datetime(2023, 2, 3, 4, 5, 6)
    assert (row.unit_concept_id, row.measurement_event_id) == (8840, 4124457)


def test_date_fallback_chain(spark):
    absent = {"sampling_datetime_utc": None}
    chain = [
        ({}, dt.date(2023, 2, 3)),
        (absent, dt.date(2023, 2, 4)),
        ({**absent, "result_datetime_utc": "?"}, dt.date(2023, 2, 5)),
        ({**absent, "result_datetime_utc": "", "report_date_utc": "?"}, AS_OF),
    ]
    rows = silver(spark, *[c for c, _ in chain]).collect()
    assert [r.measurement_date for r in rows] == [d for _, d in chain]
    assert [r.measurement_datetime.date() for r in rows] == [d for _, d in chain]
    assert [(r.measurement_year, r.measurement_month) for r in rows] == [(d.year, d.month) for _, d in chain]


def test_missing_laboratory_gives_no_id(spark):
    known, unknown = silver(spark, {}, {"laboratory_uuid": None}).collect()
    assert known.measurement_id > 0 and unknown.measurement_id is None


def test_default_as_of_is_the_run_date(spark):
    empty = {c: None for c in ("sampling_datetime_utc", "result_datetime_utc", "report_date_utc")}
    row = omop_measurement(bronze_typed(raw(spark, empty), "b")).first()
    assert abs((row.measurement_date - dt.date.today()).days) <= 1


SCHEMA = (
    "person_id bigint, measurement_date date, measurement_source_value string, "
    "unit_source_value string, unit_concept_id int, value_as_number double, "
    "value_source_value string, measurement_event_id int, measurement_year int, "
    "measurement_month int"
)

records = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 1, 1, 2, 3]),
        st.sampled_from([dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(9999, 12, 31)]),
        st.sampled_from(["A", "A", "B", ""]),
        st.sampled_from([None, "", "mg/dL", "%"]),
        st.sampled_from([0, 8840]),
        st.one_of(st.none(), st.integers(-40, 40).map(lambda v: v / 4)),
        st.sampled_from([None, "x"]),
        st.sampled_from([0, 4124457, 4135493, 4328749]),
    ),
    min_size=1,
    max_size=40,
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, r[1].year, r[1].month) for r in rows], SCHEMA
    )


def percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def groups(rows, key):
    out = {}
    for r in rows:
        out.setdefault(key(r), []).append(r)
    return out


def close(a, b):
    return a == b if a is None or b is None else a == pytest.approx(b, abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_gold_equals_brute_force(spark, rows):
    df = frame(spark, rows)
    persons = groups([r for r in rows if r[0] is not None], lambda r: r[0])
    found = {r.person_id: r for r in patient_summary(df).collect()}
    assert set(found) == set(persons)
    for person, own in persons.items():
        got = found[person]
        numbers = [r[5] for r in own if r[5] is not None]
        dates = [r[1] for r in own]
        assert got.total_measurements == len(own)
        assert got.unique_measurement_dates == len(set(dates))
        assert got.active_years == len({d.year for d in dates})
        assert got.active_months == len({d.month for d in dates})
        assert got.unique_lab_tests == len({r[2] for r in own})
        assert got.measurement_span_days == (max(dates) - min(dates)).days
        assert got.missing_value_count == sum(r[5] is None and r[6] is None for r in own)
        assert close(got.stddev_numeric_value, statistics.stdev(numbers) if len(numbers) > 1 else None)
        assert close(got.avg_numeric_value, statistics.fmean(numbers) if numbers else None)

    days = groups(rows, lambda r: (r[1], r[2], r[3]))
    trends = {(r.measurement_date, r.measurement_source_value, r.unit_source_value): r for r in measurement_trends(df).collect()}
    assert set(trends) == set(days)
    for key, own in days.items():
        numbers = [r[5] for r in own if r[5] is not None]
        got = trends[key]
        assert got.daily_test_count == len(own)
        assert got.daily_unique_patients == len({r[0] for r in own} - {None})
        assert close(got.daily_p25_value, percentile(numbers, 0.25) if numbers else None)
        assert close(got.daily_median_value, percentile(numbers, 0.5) if numbers else None)

    tests = groups([r for r in rows if r[2] != ""], lambda r: (r[2], r[3]))
    analytics = {(r.lab_test_code, r.lab_unit): r for r in laboratory_analytics(df, min_count=2).collect()}
    assert set(analytics) == {k for k, own in tests.items() if len(own) >= 2}
    for key, got in analytics.items():
        own = tests[key]
        numbers = [r[5] for r in own if r[5] is not None]
        patients = len({r[0] for r in own} - {None})
        span = (max(r[1] for r in own) - min(r[1] for r in own)).days
        assert got.unique_patients_tested == patients
        assert got.unique_test_dates == len({r[1] for r in own})
        assert close(got.p97_5_value, percentile(numbers, 0.975) if numbers else None)
        assert close(got.avg_tests_per_patient, len(own) / patients if patients else None)
        assert close(got.avg_tests_per_day, len(own) / span if span else None)


def test_thresholds_and_division_modes(spark):
    rows = [(i % 400, dt.date(2020, 1, 1 + i % 20), "A" if i < 999 else "B", None, 0, 1.0, None, 0) for i in range(1999)]
    df = frame(spark, rows)
    assert [r.lab_test_code for r in laboratory_analytics(df).collect()] == ["B"]
    whole = laboratory_analytics(df, integer_division=True).first()
    assert whole.avg_tests_per_patient == 2 and whole.avg_tests_per_day == 1000 // 19
    one_day = laboratory_analytics(df.filter("measurement_date = '2020-01-03'"), 1).first()
    assert one_day.avg_tests_per_day is None and one_day.test_span_days == 0
    stats = datamart_lab_stats(laboratory_analytics(df, 1)).first()
    assert (stats.unique_lab_test_types, stats.total_lab_tests, stats.total_patients_with_tests) == (2, 1999, 800)
    patients = datamart_patient_stats(patient_summary(df)).first()
    assert patients.total_patients == 400 and patients.patients_with_10plus_measurements == 0


def test_percentiles_are_exact(spark):
    """Long decimals, negatives, ties, infinities and a group with a third of the rows."""
    i = F.col("id")
    df = spark.range(0, 6000, numPartitions=5).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 70).cast("string"))).alias("k"),
        (F.exp(i % 977 / 90) * 1.23456789 - 3000 * (i % 2)).alias("value_as_number"),
    )
    at = {"least": 0.0, "a": 0.025, "b": 0.5, "c": 0.975, "most": 1.0}
    found = {r.k: r for r in grouped_percentiles(df, ["k"], at).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r.k, []).append(r.value_as_number)
    assert set(found) == set(groups)
    for k, own in groups.items():
        for name, p in at.items():
            assert found[k][name] == pytest.approx(percentile(sorted(own), p), rel=1e-12)
        assert found[k].least <= found[k].b <= found[k].most
    close_by = spark.createDataFrame([(x,) for x in (100004.0, 100004.1, 100004.2)], "value_as_number double")
    assert grouped_percentiles(close_by, [], {"m": 0.5}).first().m == 100004.1
    odd = [0.0, -5.0, float("inf"), float("-inf"), 5e-324, 1e308, None]
    odd = spark.createDataFrame([("k", x) for x in odd], "k string, value_as_number double")
    row = grouped_percentiles(odd, ["k"], {"lo": 0.0, "p": 0.2, "z": 0.4, "t": 0.6, "h": 0.8, "hi": 1.0}).first()
    assert tuple(row)[1:] == (float("-inf"), -5.0, 0.0, 5e-324, 1e308, float("inf"))
    plan = grouped_percentiles(df, ["k"], at)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan


def test_concepts_join_alike_with_and_without_broadcast(spark):
    m = silver(spark, *[{"measurement_source_value": c} for c in ("LC:1", "LC:1", "LC:2", "LC:9")])
    concept = spark.createDataFrame(
        [(11, "LC:1", "LOINC"), (10, "LC:1", "LOINC"), (5, "LC:1", "Local"), (7, "LC:2", "Local"), (8, "X-2", "LOINC"), (9, None, "LOINC")],
        "concept_id bigint, concept_code string, vocabulary_id string",
    )
    for limit in ("1m", "-1"):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
        joined = concept_lookup(m, concept)
        assert joined.count() == 7
        filled = concept_backfill(m, concept)
        assert filled.columns == m.columns
        assert sorted(r.measurement_concept_id for r in filled.collect()) == [0, 0, 10, 10]
        codes = spark.createDataFrame([("LC:2", "X-2")], "source_code string, concept_code string")
        mapped = concept_backfill(m, concept, codes)
        assert sorted(r.measurement_concept_id for r in mapped.collect()) == [0, 0, 0, 8]
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    report = audits.omop_validation(filled).first()
    assert (report.mapped_measurements, report.mapping_rate_pct) == (2, 50.0)
    assert audits.omop_validation(m.limit(0)).first().mapping_rate_pct == 0.0


def test_audits_on_edges(spark):
    rows = bronze_typed(
        raw(
            spark,
            {"patient_id": " ", "visit_id": "0", "value_as_number": "0"},
            {"patient_id": "", "value_as_number": "NaN", "value_as_string": " "},
            {"patient_id": None, "value_as_number": "4"},
            {"sampling_datetime_utc": "1850-01-01"},
            {"sampling_datetime_utc": "2999-01-01"},
            {"sampling_datetime_utc": None},
        ),
        "b",
        partition_columns=True,
    )
    strict = audits.bronze_stats(rows, strict=True).first()
    assert (strict.unique_patients, strict.unique_visits, strict.numeric_values) == (1, 1, 4)
    assert (strict.string_values, strict.null_dates) == (0, 1)
    assert strict.avg_numeric_value == (4 + 3 * 5.5) / 4
    audit = audits.partition_audit(rows, dt.date(2024, 1, 1)).first()
    assert (audit.years_spanned, audit.invalid_years, audit.sentinel_rows) == (1, 2, 1)
    profile = audits.patient_id_profile(rows).first()
    assert (profile.valid_patients, profile.null_patients, profile.empty_patients) == (4, 1, 1)
    empty = rows.limit(0)
    assert audits.coverage(audits.bronze_stats(empty, strict=True)).first().patients_per_row_pct is None


def test_reconcile_verdicts(spark):
    want = spark.createDataFrame([("a",)] * 4 + [("b",)] * 2 + [("c",)], "source_file string")
    have = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("d",)], "source_file string")
    rows = {r.source_file: r for r in audits.reconcile(want, have).collect()}
    assert {k: r.verdict for k, r in rows.items()} == {
        "a": "FILTERED_OUT",
        "b": "DUPLICATES",
        "c": "FILTERED_OUT",
        "d": "DUPLICATES",
        None: "MATCH",
    }
    assert rows[None].is_total and rows["a"].difference_pct == 25.0
    assert rows["d"].success_rate_pct is None


def test_reconcile_sees_a_swapped_row(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", 3, "y"), ("c", 4, "z")]
    want = spark.createDataFrame(rows, "source_file string, v int, w string")

    def verdicts(actual):
        have = spark.createDataFrame(actual, want.schema).repartition(3)
        return {r.source_file: r.verdict for r in audits.reconcile_content(want, have, ["v", "w"]).collect()}

    assert verdicts(rows[::-1]) == {"a": "MATCH", "b": "MATCH", "c": "MATCH", None: "MATCH"}
    swapped = [("a", 1, "x"), ("a", 2, None), ("a", 2, None), ("b", 3, "y"), ("c", 4, None)]
    assert verdicts(swapped) == {"a": "CHANGED", "b": "MATCH", "c": "CHANGED", None: "CHANGED"}
    assert verdicts(rows[1:] + [("b", 3, "y")] * 2)["a"] == "FILTERED_OUT"
    assert verdicts(rows + [("d", 3, "y")])["d"] == "DUPLICATES"


def test_grades(spark):
    df = spark.createDataFrame(
        [(85.0, 1000, 700_000_000, 5_000_000, 60)],
        "mapping_rate_pct double, files_processed int, total_records int, unique_patients int, unique_lab_test_types int",
    )
    row = audits.quality_grades(df).first()
    assert row.mapping_grade == "EXCELLENT" and row.files_grade == "COMPLETE"
    assert row.rows_grade == "SUCCESS" and row.patients_grade == "EXCELLENT"
    assert row.test_types_grade == "GOOD"
