"""Column functions and bronze rows on edge values."""

import datetime as dt
import hashlib
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from labmart import functions as lf
from labmart import mappings
from labmart.operators.bronze import bronze_enhanced, bronze_typed, patient_filter
from tests.rows import raw

RUN = dt.datetime(2024, 5, 6, 7, 8, 9)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_unit_concepts_match_exactly(spark):
    units = [*mappings.UNIT_CONCEPTS, "", None, "   ", "furlong", " mg/dL", "MG/DL"]
    df = spark.createDataFrame([(u,) for u in units], "u string")
    found = [r[0] for r in df.select(lf.unit_concept("u")).collect()]
    assert found == [*mappings.UNIT_CONCEPTS.values(), 0, 0, 0, 0, 0, 0]
    custom = df.select(lf.unit_concept("u", {"furlong": 9})).collect()
    assert [r[0] for r in custom].count(9) == 1


def test_normality_ignores_case_and_spaces(spark):
    texts = [" high ", "Normal", "LOW", "ABNORMAL", None, "odd", ""]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    found = [r[0] for r in df.select(lf.normality_concept("n")).collect()]
    assert found == [4328749, 4124457, 4124457, 4135493, 0, 0, 0]


def test_scores_domains_and_flags(spark):
    df = spark.createDataFrame(
        [
            (1.0, "mg/dL", None),
            (1.0, None, "text"),
            (None, "mg/dL", "text"),
            (None, None, ""),
            (None, None, "  "),
            (0.0, "", None),
            (None, None, None),
        ],
        "v double, u string, s string",
    )
    assert values(
        df,
        lf.quality_score("v", "u", "s"),
        lf.quality_score("v", "u", "s", trimmed=True),
        lf.omop_target_domain("v", "s"),
        lf.categorical_flag("s", "v"),
        lf.value_source_value("s", "v"),
    ) == [
        (1.0, 1.0, "Measurement", None, "1.0"),
        (0.8, 0.8, "Measurement", None, "text"),
        (0.8, 0.8, "Observation", 0, "text"),
        (0.5, 0.5, "Observation", 0, ""),
        (0.8, 0.5, "Observation", 0, "  "),
        (1.0, 1.0, "Measurement", None, "0.0"),
        (0.5, 0.5, "Unknown", None, None),
    ]


def test_categories(spark):
    pairs = [(u, c) for c, us in mappings.TEST_CATEGORIES.items() for u in us]
    pairs += [("other", "Other"), (None, "Other")]
    df = spark.createDataFrame(pairs, "u string, c string")
    assert df.filter(lf.lab_category("u") != F.col("c")).count() == 0


def test_hashes_agree_with_other_libraries(spark):
    df = spark.createDataFrame([("12", 7, "LAB", "LC:1"), (None, 7, "LAB", "LC:1")], "p string, v bigint, l string, c string")
    known, unknown = df.select(
        lf.person_hash64("p"),
        lf.pseudonym("p"),
        lf.audit_hash("p", "v"),
        lf.measurement_id("p", "l", "c"),
    ).collect()
    assert known[0] == xxhash.xxh64_intdigest(b"12", seed=42) & 0x7FFFFFFFFFFFFFFF
    assert known[1] == hashlib.sha256(b"12").hexdigest().upper()[:32]
    assert known[2] == hashlib.sha256(b"127").hexdigest().upper()[:16]
    assert known[3] == zlib.crc32(b"12_LAB_LC:1")
    assert tuple(unknown) == (None, None, None, None)
    salted = df.select(lf.pseudonym("p", "s3")).first()[0]
    assert salted == hashlib.sha256(b"s312").hexdigest().upper()[:32]


def test_vocabulary_dates(spark):
    df = spark.createDataFrame([("1970-01-01",), ("19700101",), ("x",), (None,)], "d string")
    day = dt.date(1970, 1, 1)
    assert values(df, lf.yyyymmdd_or_iso_date("d")) == [(day,), (day,), (None,), (None,)]


@pytest.mark.parametrize(
    "text, year, month, parsed",
    [
        (None, 1900, 1, None),
        ("", 1900, 1, None),
        ("soon", 1900, 1, None),
        ("2021-07-08", 2021, 7, dt.datetime(2021, 7, 8)),
        ("2021-07-08 09:10:11", 2021, 7, dt.datetime(2021, 7, 8, 9, 10, 11)),
        ("2021-07-08T09:10:11Z", 2021, 7, dt.datetime(2021, 7, 8, 9, 10, 11)),
        ("1900-05-01", 1900, 5, dt.datetime(1900, 5, 1)),
    ],
)
def test_partition_columns(spark, text, year, month, parsed):
    df = bronze_typed(
        raw(spark, {"sampling_datetime_utc": text}), "b", RUN, partition_columns=True
    )
    assert values(df, "year", "month", "sampling_datetime_utc") == [(year, month, parsed)]


def test_bronze_casts_tolerate_bad_text(spark):
    changes = [{"value_as_number": v, "visit_id": v} for v in ("abc", "NaN", "0", "12.5", None)]
    rows = values(bronze_typed(raw(spark, *changes), "b", RUN), "value_as_number", "visit_id")
    assert rows[0] == (None, None)
    assert rows[1][0] != rows[1][0] and rows[1][1] is None
    assert rows[2:] == [(0.0, 0), (12.5, None), (None, None)]
    first = bronze_typed(raw(spark, {}), "b", RUN).first()
    assert first["provider_id"] == "55" and first["abnormal_flag"] == ""
    assert first["load_timestamp"] == RUN and first["processing_batch"] == "b"


def test_patient_filter_modes(spark):
    ids = [None, "", "   ", "nan", "P12", "12"]
    df = bronze_typed(
        raw(spark, *[{"patient_id": i, "visit_id": "1" if i != "P12" else "x"} for i in ids]), "b"
    )
    kept = {
        mode: sorted(r[0] or "" for r in patient_filter(df, mode).select("patient_id").collect())
        for mode in ("nonblank", "trimmed", "with_visit", "not_nan")
    }
    assert patient_filter(df, "all").count() == 6
    assert kept == {
        "nonblank": ["   ", "12", "P12", "nan"],
        "trimmed": ["12", "P12", "nan"],
        "with_visit": ["   ", "12", "nan"],
        "not_nan": ["   ", "12", "P12"],
    }


def test_enhanced_versions(spark):
    typed = bronze_typed(raw(spark, {}, {"normality": None}), "b", RUN)
    five = bronze_enhanced(typed, 5, row_id=None)
    assert values(five, "value_qualifier", "visit_date") == [
        ("Normal", dt.date(2023, 2, 3)),
        ("", dt.date(2023, 2, 3)),
    ]
    text = bronze_typed(
        raw(spark, {}, {"sampling_datetime_utc": "2023-02-03T04:05:06"}, {"patient_id": None}),
        "b",
        RUN,
        strings=True,
    )
    seven = bronze_enhanced(text, 7, row_id=None)
    assert values(seven, "sampling_datetime_parsed", "measurement_year") == [
        (dt.datetime(2023, 2, 3, 4, 5, 6), 2023),
        (None, None),
    ]
    with pytest.raises(ValueError):
        bronze_enhanced(typed, 6)
