"""Vocabulary tables from text scans, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labmart.functions import not_blank, tolerant, yyyymmdd_or_iso_date
from labmart.mappings import SEED_CONCEPTS
from labmart.schemas import CONCEPT_DDL, VOCAB_FILES


def load_vocabulary(raw: DataFrame) -> DataFrame:
    """Vocabularies with an id; the concept id becomes a number."""
    text = VOCAB_FILES["VOCABULARY.csv"][:-1]
    return raw.filter(not_blank("vocabulary_id")).select(
        *text, tolerant("vocabulary_concept_id", "bigint").alias("vocabulary_concept_id")
    )


def _numeric_ids(raw: DataFrame, *ids: str) -> DataFrame:
    typed = raw.withColumns({c: tolerant(c, "bigint") for c in ids})
    return typed.dropna(subset=list(ids))


def _typed_dates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: yyyymmdd_or_iso_date(c) for c in ("valid_start_date", "valid_end_date")}
    )


def load_concept(raw: DataFrame) -> DataFrame:
    """Concepts with a numeric id. Cluster by vocabulary_id, concept_code, concept_id on write."""
    return _typed_dates(_numeric_ids(raw, "concept_id")).select(*VOCAB_FILES["CONCEPT.csv"])


def load_concept_relationship(raw: DataFrame) -> DataFrame:
    """Relationships with two numeric ids. Cluster by relationship_id and the ids on write."""
    return _typed_dates(_numeric_ids(raw, "concept_id_1", "concept_id_2")).select(
        *VOCAB_FILES["CONCEPT_RELATIONSHIP.csv"]
    )


def load_domain(raw: DataFrame) -> DataFrame:
    """Domains with an id; all columns stay text."""
    return raw.filter(not_blank("domain_id")).select(*VOCAB_FILES["DOMAIN.csv"])


CONCEPT_CLUSTERING = ["vocabulary_id", "concept_code", "concept_id"]
RELATIONSHIP_CLUSTERING = ["relationship_id", "concept_id_1", "concept_id_2"]


def seed_concepts(spark: SparkSession) -> DataFrame:
    """The few LOINC concepts an empty concept table starts with."""
    rows = spark.createDataFrame(
        list(SEED_CONCEPTS), "concept_id bigint, concept_name string, concept_code string"
    )
    filled = rows.withColumns(
        {
            "domain_id": F.lit("Measurement"),
            "vocabulary_id": F.lit("LOINC"),
            "concept_class_id": F.lit("Lab Test"),
            "standard_concept": F.lit("S"),
            "valid_start_date": F.lit("1970-01-01").cast("date"),
            "valid_end_date": F.lit("2099-12-31").cast("date"),
            "invalid_reason": F.lit(None).cast("string"),
        }
    )
    return filled.to(spark.createDataFrame([], CONCEPT_DDL).schema)


def vocab_validation(vocabulary: DataFrame) -> DataFrame:
    """Counts over the vocabulary table and the four checks made on them."""
    counts = vocabulary.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("vocabulary_id").alias("unique_vocabs"),
        F.count("vocabulary_name").alias("named_vocabs"),
        F.min(F.length("vocabulary_id")).alias("min_id_length"),
        F.max(F.length("vocabulary_id")).alias("max_id_length"),
    )
    return counts.withColumns(
        {
            "not_empty": F.col("total_rows") > 0,
            "unique_ids": F.col("unique_vocabs") == F.col("total_rows"),
            "has_names": F.col("named_vocabs") > 0,
            "usual_id_lengths": F.coalesce(
                (F.col("min_id_length") >= 2) & (F.col("max_id_length") <= 50), F.lit(False)
            ),
        }
    )
