"""What the numbering of the enhanced table moves and stores."""

import datetime as dt

from labmart.operators import rowid
from labmart.operators.bronze import bronze_enhanced, bronze_typed, enhance
from labmart.plans import bronze_to_enhanced
from rows import raw


def _texts(spark):
    return bronze_typed(
        raw(spark, {}, {"patient_id": None}, {"visit_id": "3"}, {"sampling_datetime_utc": None}, {}), "b", dt.datetime(2024, 1, 1), strings=True
    )


def test_derived_columns_are_not_stored_for_the_numbering(spark, monkeypatch):
    stored = {}

    def spy(df, label, *more):
        stored[label] = df.columns
        return kept(df, label, *more)

    kept = rowid.store
    monkeypatch.setattr(rowid, "store", spy)
    texts = _texts(spark)
    rows = bronze_enhanced(texts, 7)
    assert set(stored["located"]) == {*texts.columns, "__stretch", "__row", "__tie"}
    assert rows.columns == [*enhance(texts, 7).columns, "measurement_id"]
    found = rows.orderBy("measurement_id").collect()
    assert [(r.measurement_id, r.visit_id, r.sampling_datetime_utc is None) for r in found] == [
        (1, 3, False), (2, 7, False), (3, 7, False), (4, 7, True)
    ]
    assert {len(r.person_id_anonymized) for r in found} == {32}


def test_enhanced_table_has_all_columns_of_the_rows(spark, database):
    texts = _texts(spark)
    table = spark.table(bronze_to_enhanced(spark, texts, f"{database}.results"))
    rows = bronze_enhanced(texts, 7)
    assert set(table.columns) == {*rows.columns, "patient_bucket"}
    assert table.columns[-2:] == ["patient_bucket", "measurement_year"]
    assert sorted(table.select(*rows.columns).collect(), key=str) == sorted(rows.collect(), key=str)
