from labmart.functions.clinical import (
    categorical_flag,
    lab_category,
    measurement_id,
    measurement_key64,
    normality_concept,
    omop_target_domain,
    quality_score,
    unit_concept,
    value_qualifier,
    value_source_value,
)
from labmart.functions.identity import audit_hash, person_hash64, pseudonym, sha256_prefix
from labmart.functions.text import is_blank, not_blank, tolerant, yyyymmdd_or_iso_date
from labmart.functions.time import at_run, first_date, first_datetime, month_or, year_or

__all__ = [name for name in dir() if not name.startswith("_")]
