"""Joining test codes to vocabulary concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labmart.sinks.tables import write_table

CODE, SLOT = "measurement_source_value", "code_slot"


def concept_lookup(bronze: DataFrame, concept: DataFrame, columns=None) -> DataFrame:
    """Inner join of rows with concepts on the test code.

    A code held by several vocabularies gives several rows; filter ``concept``
    first where one is wanted. The concept side is cut to the wanted columns;
    AQE broadcasts it if it turns out small (``build_session`` sets 128 MB) and
    splits hot codes otherwise.
    """
    wanted = ["concept_code", *(columns or [c for c in concept.columns if c != "concept_code"])]
    side = concept.select(*wanted).filter(F.col("concept_code").isNotNull())
    return bronze.join(side, F.col("measurement_source_value") == F.col("concept_code"), "inner")


def code_concepts(
    concept: DataFrame, code_map: DataFrame | None = None, vocabularies=("LOINC",)
) -> DataFrame:
    """One concept per source code: (measurement_source_value, concept_id).

    ``code_map`` (source_code, concept_code) translates local codes; without it
    source codes are looked up as they are. Of several candidates the smallest
    concept id counts, so the result cannot multiply rows.
    """
    known = concept.filter(F.col("vocabulary_id").isin(*vocabularies)).select(
        "concept_code", "concept_id"
    )
    if code_map is not None:
        known = known.join(code_map, "concept_code").select(
            F.col("source_code").alias("concept_code"), "concept_id"
        )
    return known.groupBy(F.col("concept_code").alias("measurement_source_value")).agg(
        F.min("concept_id").alias("concept_id")
    )


def concept_backfill(
    measurement: DataFrame,
    concept: DataFrame,
    code_map: DataFrame | None = None,
    vocabularies=("LOINC",),
) -> DataFrame:
    """Fill both concept ids of MEASUREMENT; 0 where the code has no concept."""
    codes = code_concepts(concept, code_map, vocabularies).withColumnRenamed(
        "measurement_source_value", "concept_code"
    )
    side = codes.withColumnRenamed("concept_id", "__found")
    joined = measurement.join(
        side, F.col("measurement_source_value") == F.col("concept_code"), "left"
    )
    found = F.coalesce(F.col("__found"), F.lit(0)).cast("int")
    filled = {"measurement_concept_id", "measurement_source_concept_id"}
    return joined.select(
        *[found.alias(c) if c in filled else F.col(c) for c in measurement.columns]
    )


def write_by_code(
    rows: DataFrame,
    concept: DataFrame,
    rows_table: str,
    concept_table: str,
    buckets: int = 64,
    rows_per_slot: int = 1_000_000,
) -> tuple[str, str]:
    """Rows and concepts as tables bucketed alike, for joins that exchange neither.

    The buckets are by ``code_slot``. A code with many rows has several slots,
    which spread over the buckets, and its concepts stand once in each of them;
    so no bucket holds all rows of a frequent code. Rows without a code have a
    slot of their own and meet nothing. ``slot_lookup`` joins the tables.
    """
    slots = rows.where(F.col(CODE).isNotNull()).groupBy(F.col(CODE).alias("__code")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_slot).alias("__slots")
    )
    spread = F.pmod(F.xxhash64(*rows.columns), F.col("__slots"))
    placed = rows.join(slots, F.col(CODE) == F.col("__code"), "left").withColumn(
        SLOT, F.xxhash64("__code", spread)
    )
    known = concept.join(slots, F.col("concept_code") == F.col("__code")).withColumn(
        "__slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__slots") - 1))
    )
    repeated = known.withColumn(SLOT, F.xxhash64("__code", F.col("__slot")))
    layout = {"bucket_by": (buckets, SLOT), "sort_by": [SLOT]}
    write_table(placed.drop("__code", "__slots"), rows_table, **layout)
    write_table(repeated.drop("__code", "__slots", "__slot"), concept_table, **layout)
    return rows_table, concept_table


def slot_lookup(rows: DataFrame, concept: DataFrame, columns=None) -> DataFrame:
    """``concept_lookup`` over the tables of ``write_by_code``, without an exchange on either side.

    Slots are hashes, so the codes are compared as well, in a form that does
    not become a second join key, which the buckets would not satisfy.
    """
    wanted = [SLOT, "concept_code", *(columns or [c for c in concept.columns if c not in ("concept_code", SLOT)])]
    side = concept.select(*wanted).withColumnRenamed(SLOT, "__slot")
    code, known = F.col(CODE), F.col("concept_code")
    same = (F.col(SLOT) == F.col("__slot")) & (code <= known) & (code >= known)
    return rows.join(side, same).drop(SLOT, "__slot")
