"""Research tables over OMOP MEASUREMENT."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labmart.functions import lab_category
from labmart.mappings import ABNORMAL_CONCEPT, HIGH_CONCEPT, NORMAL_CONCEPT
from labmart.operators.selection import LISTED, distinct_items, percentiles, tally

VALUE = "value_as_number"


def _missing() -> Column:
    return F.count_if(F.col(VALUE).isNull() & F.col("value_source_value").isNull())


def _event(concept: int) -> Column:
    return F.count_if(F.col("measurement_event_id") == concept)


def _percent(part: Column) -> Column:
    return F.round(F.lit(100.0) * part / F.count(F.lit(1)), 2)


def _span(c: str) -> Column:
    return F.datediff(F.max(c), F.min(c)).cast("bigint")


def _joined(base: DataFrame, sides: list[DataFrame], keys: list[str], counts=()) -> DataFrame:
    """Left-join aggregates on their common keys; each is already partitioned by them."""
    whole = reduce(lambda a, b: a.join(b, keys, "left"), sides, base)
    return whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def _activity(measurement: DataFrame) -> DataFrame:
    """Distinct dates, years, months and tests of each person, from one scan.

    The days of a person's year are bits of six integers, which combine before
    the exchange however many rows there are; tests are unique (person, test)
    pairs of the same aggregate.
    """
    date, day = F.col("measurement_date"), F.dayofyear("measurement_date") - 1
    one = F.lit(1).cast("bigint")
    bits = {f"__days{i}": F.when(F.floor(day / 64) == i, F.call_function("shiftleft", one, day % 64)) for i in range(6)}
    bits["__months"] = F.call_function("shiftleft", one, F.month(date) - 1)
    test = F.col("measurement_source_value").alias("__test")
    rows = measurement.select("person_id", F.year(date).alias("__year"), test, *[v.alias(k) for k, v in bits.items()])
    sets = [["person_id", "__year"], ["person_id", "__test"]]
    found = rows.groupingSets(sets, "person_id", "__year", "__test").agg(*[F.bit_or(c).alias(c) for c in bits])
    dated = F.col("__year").isNotNull()
    days = sum((F.coalesce(F.bit_count(f"__days{i}"), F.lit(0)) for i in range(6)), F.lit(0).cast("bigint"))
    return found.groupBy("person_id").agg(
        F.sum(F.when(dated, days).otherwise(0)).alias("unique_measurement_dates"),
        F.count("__year").alias("active_years"),
        F.coalesce(F.bit_count(F.bit_or(F.when(dated, F.col("__months")))), F.lit(0)).cast("bigint").alias("active_months"),
        F.count("__test").alias("unique_lab_tests"),
    )


def patient_summary(measurement: DataFrame) -> DataFrame:
    """One row per person: volumes, time span, diversity, values, quality.

    Two scans of the stored table: one for the plain aggregates, one for the
    distinct dates and tests, joined per person. Each combines before it
    shuffles, and the distinct ones shuffle on (person, item): a person with a
    large share of all rows still spreads over many tasks.
    """
    rows = measurement.filter(F.col("person_id").isNotNull())
    plain = rows.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("total_measurements"),
        F.count(VALUE).alias("numeric_measurements"),
        F.count_if(F.col("unit_concept_id") > 0).alias("measurements_with_units"),
        F.min("measurement_date").alias("first_measurement_date"),
        F.max("measurement_date").alias("last_measurement_date"),
        _span("measurement_date").alias("measurement_span_days"),
        _event(ABNORMAL_CONCEPT).alias("abnormal_results"),
        _event(HIGH_CONCEPT).alias("high_results"),
        _event(NORMAL_CONCEPT).alias("normal_low_results"),
        F.avg(VALUE).alias("avg_numeric_value"),
        F.min(VALUE).alias("min_numeric_value"),
        F.max(VALUE).alias("max_numeric_value"),
        F.stddev_samp(VALUE).alias("stddev_numeric_value"),
        _missing().alias("missing_value_count"),
        F.year(F.min("measurement_date")).alias("patient_year_of_first_measurement"),
    )
    counts = ["unique_measurement_dates", "active_years", "active_months", "unique_lab_tests"]
    return _joined(plain, [_activity(rows)], ["person_id"], counts).select(
        "person_id",
        "total_measurements",
        "unique_measurement_dates",
        "numeric_measurements",
        "measurements_with_units",
        "first_measurement_date",
        "last_measurement_date",
        "measurement_span_days",
        "unique_lab_tests",
        "abnormal_results",
        "high_results",
        "normal_low_results",
        "avg_numeric_value",
        "min_numeric_value",
        "max_numeric_value",
        "stddev_numeric_value",
        "missing_value_count",
        "active_years",
        "active_months",
        "patient_year_of_first_measurement",
    )


def grouped_percentiles(
    df: DataFrame, keys: list[str], names: dict[str, float], listed: int = LISTED
) -> DataFrame:
    """Exact percentiles of the measured value per group; see ``selection``.

    Keys must not be NULL. Groups without a value are left out.
    """
    if keys:
        return percentiles(tally(df, keys, F.col(VALUE), []), keys, names, listed)
    one = df.withColumn("__one", F.lit(0))
    return grouped_percentiles(one, ["__one"], names, listed).drop("__one")


def _keyed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Replace the unit by two columns without NULL, so that plain equality joins the groups."""
    unit = F.col("unit_source_value")
    keyed = df.withColumns({"__unit": F.coalesce(unit, F.lit("")), "__no_unit": unit.isNull()})
    return keyed, ["__unit", "__no_unit"]


def _unit() -> Column:
    return F.when(~F.col("__no_unit"), F.col("__unit"))


def measurement_trends(measurement: DataFrame) -> DataFrame:
    """One row per day, test and unit: volumes, value distribution, abnormal shares.

    Two scans: one for the plain aggregates, one that tallies persons and
    values of each group into the shared folder, which runs at once. To build
    some years only, filter ``measurement`` by its partition columns.
    """
    days = ["measurement_year", "measurement_month", "measurement_date"]
    dated = measurement.dropna(subset=["measurement_date", "measurement_source_value"])
    date = F.col("measurement_date")
    rows, unit_keys = _keyed(
        dated.withColumns(
            {
                "measurement_year": F.coalesce("measurement_year", F.year(date)),
                "measurement_month": F.coalesce("measurement_month", F.month(date)),
            }
        )
    )
    keys = [*days, "measurement_source_value", *unit_keys]
    daily = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("daily_test_count"),
        F.avg(VALUE).alias("daily_avg_value"),
        F.min(VALUE).alias("daily_min_value"),
        F.max(VALUE).alias("daily_max_value"),
        F.stddev_samp(VALUE).alias("daily_stddev_value"),
        _event(ABNORMAL_CONCEPT).alias("daily_abnormal_count"),
        _event(HIGH_CONCEPT).alias("daily_high_count"),
        _event(NORMAL_CONCEPT).alias("daily_normal_low_count"),
        _percent(_event(ABNORMAL_CONCEPT)).alias("pct_abnormal"),
        _percent(F.count(VALUE)).alias("pct_numeric"),
        _missing().alias("daily_missing_values"),
    )
    wanted = {"daily_median_value": 0.5, "daily_p25_value": 0.25, "daily_p75_value": 0.75}
    tallied = tally(rows, keys, F.col(VALUE), [F.col("person_id")])
    sides = [
        distinct_items(tallied, keys, ["daily_unique_patients"]),
        percentiles(tallied, keys, wanted),
    ]
    return _joined(daily, sides, keys, ["daily_unique_patients"]).select(
        *days,
        "measurement_source_value",
        _unit().alias("unit_source_value"),
        "daily_test_count",
        "daily_unique_patients",
        "daily_avg_value",
        *wanted,
        "daily_min_value",
        "daily_max_value",
        "daily_stddev_value",
        "daily_abnormal_count",
        "daily_high_count",
        "daily_normal_low_count",
        "pct_abnormal",
        "pct_numeric",
        "daily_missing_values",
    )


def laboratory_analytics(
    measurement: DataFrame,
    min_count: int = 1000,
    integer_division: bool = False,
) -> DataFrame:
    """One row per test and unit with at least ``min_count`` results.

    ``integer_division`` truncates the two per-patient and per-day averages to
    whole numbers instead of keeping them as doubles. Two scans, as for
    ``measurement_trends``.
    """
    rows, unit_keys = _keyed(measurement.filter(F.col("measurement_source_value") != ""))
    keys = ["measurement_source_value", *unit_keys]
    total = F.count(F.lit(1))
    stats = (
        rows.groupBy(*keys)
        .agg(
            total.alias("total_test_count"),
            F.min("measurement_date").alias("earliest_test_date"),
            F.max("measurement_date").alias("latest_test_date"),
            _span("measurement_date").alias("test_span_days"),
            F.count(VALUE).alias("numeric_result_count"),
            F.avg(VALUE).alias("avg_numeric_result"),
            F.min(VALUE).alias("min_numeric_result"),
            F.max(VALUE).alias("max_numeric_result"),
            F.stddev_samp(VALUE).alias("stddev_numeric_result"),
            _event(ABNORMAL_CONCEPT).alias("abnormal_result_count"),
            _event(HIGH_CONCEPT).alias("high_result_count"),
            _event(NORMAL_CONCEPT).alias("normal_low_result_count"),
            _percent(_event(ABNORMAL_CONCEPT)).alias("pct_abnormal"),
            _percent(F.count(VALUE)).alias("pct_numeric"),
            _missing().alias("missing_value_count"),
            _percent(_missing()).alias("pct_missing"),
        )
        .filter(F.col("total_test_count") >= min_count)
    )
    wanted = {"median_numeric_result": 0.5, "p2_5_value": 0.025, "p97_5_value": 0.975}

    def ratio(part: Column, whole: Column) -> Column:
        divided = part / whole
        return divided.cast("bigint") if integer_division else divided

    items = [F.col("person_id"), F.unix_date("measurement_date")]
    tallied = tally(rows, keys, F.col(VALUE), items)
    counts = ["unique_patients_tested", "unique_test_dates"]
    sides = [distinct_items(tallied, keys, counts), percentiles(tallied, keys, wanted)]
    return _joined(stats, sides, keys, counts).select(
        F.col("measurement_source_value").alias("lab_test_code"),
        _unit().alias("lab_unit"),
        lab_category(_unit()).alias("test_category"),
        "total_test_count",
        "unique_patients_tested",
        "unique_test_dates",
        "earliest_test_date",
        "latest_test_date",
        "test_span_days",
        "numeric_result_count",
        "avg_numeric_result",
        "median_numeric_result",
        "min_numeric_result",
        "max_numeric_result",
        "stddev_numeric_result",
        "p2_5_value",
        "p97_5_value",
        "abnormal_result_count",
        "high_result_count",
        "normal_low_result_count",
        "pct_abnormal",
        "pct_numeric",
        "missing_value_count",
        "pct_missing",
        ratio(
            F.col("total_test_count"), F.nullif(F.col("unique_patients_tested"), F.lit(0))
        ).alias("avg_tests_per_patient"),
        ratio(F.col("total_test_count"), F.nullif(F.col("test_span_days"), F.lit(0))).alias(
            "avg_tests_per_day"
        ),
    )


def datamart_patient_stats(summary: DataFrame) -> DataFrame:
    """Totals and averages over the patient summary."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_patients"),
        F.avg("total_measurements").alias("avg_measurements_per_patient"),
        F.avg("measurement_span_days").alias("avg_measurement_span_days"),
        F.avg("unique_lab_tests").alias("avg_lab_tests_per_patient"),
        F.sum("abnormal_results").alias("total_abnormal_results"),
        F.count_if(F.col("total_measurements") >= 10).alias("patients_with_10plus_measurements"),
    )


def datamart_lab_stats(analytics: DataFrame) -> DataFrame:
    """Totals over laboratory analytics.

    ``total_patients_with_tests`` adds the patients of each test, so a person
    counts once per test.
    """
    return analytics.agg(
        F.count(F.lit(1)).alias("unique_lab_test_types"),
        F.count_distinct("test_category").alias("test_categories"),
        F.sum("total_test_count").alias("total_lab_tests"),
        F.sum("unique_patients_tested").alias("total_patients_with_tests"),
        F.avg("pct_abnormal").alias("avg_abnormal_percentage"),
    )
