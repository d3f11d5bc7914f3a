"""Column expressions with clinical meaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from labmart import mappings
from labmart.functions.text import _col, tolerant


def _lookup(key: Column, table: Mapping[str, int]) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[key], F.lit(0))


def unit_concept(c, table: Mapping[str, int] | None = None) -> Column:
    """Unit concept by exact text; 0 for blank and unknown units."""
    return _lookup(_col(c), table or mappings.UNIT_CONCEPTS)


def normality_concept(c) -> Column:
    """Qualifier concept, ignoring case and outer spaces; 0 when unknown."""
    return _lookup(F.upper(F.trim(_col(c))), mappings.NORMALITY_CONCEPTS)


def categorical_flag(text, number) -> Column:
    """0 for a result that only has text, else NULL."""
    return F.when(_col(text).isNotNull() & tolerant(number, "double").isNull(), F.lit(0))


def measurement_id(patient, laboratory, code) -> Column:
    """CRC-32 of patient, laboratory and test; NULL if any is NULL.

    32 bits and no time in the key: equal for repeated tests and not unique on
    large tables. Use ``measurement_key64`` or ``global_row_id`` for a key.
    """
    sep = F.lit("_")
    return F.crc32(F.encode(F.concat(_col(patient), sep, _col(laboratory), sep, _col(code)), "UTF-8"))


def measurement_key64(*columns) -> Column:
    """Non-negative 64-bit hash of the given columns, for use where 32 bits collide."""
    return F.xxhash64(*[_col(c) for c in columns]).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def quality_score(number, unit, text, trimmed: bool = False) -> Column:
    """1.0 for a number with unit, 0.8 for text, 0.5 otherwise.

    ``trimmed`` also treats text made of spaces as missing.
    """
    words = F.trim(_col(text)) if trimmed else _col(text)
    return (
        F.when(_col(number).isNotNull() & _col(unit).isNotNull(), F.lit(1.0))
        .when(words != "", F.lit(0.8))
        .otherwise(F.lit(0.5))
    )


def omop_target_domain(number, text) -> Column:
    return (
        F.when(_col(number).isNotNull(), "Measurement")
        .when(_col(text).isNotNull(), "Observation")
        .otherwise("Unknown")
    )


def value_qualifier(normality, abnormal_flag) -> Column:
    return F.coalesce(_col(normality), _col(abnormal_flag), F.lit("Unknown"))


def value_source_value(text, number) -> Column:
    return F.coalesce(_col(text), _col(number).cast("string"))


def lab_category(unit) -> Column:
    """Category of a test by its unit."""
    chain = None
    for category, units in mappings.TEST_CATEGORIES.items():
        hit = _col(unit).isin(*units)
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain.otherwise(mappings.OTHER_CATEGORY)
