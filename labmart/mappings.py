"""Code tables, kept as data so that a site can correct them."""

from __future__ import annotations

# Unit text to OMOP unit concept. Matching is exact.
# nmol/L shares the mmol/L concept; pass a corrected table where that matters.
UNIT_CONCEPTS = {
    "mg/dL": 8840,
    "mmol/L": 8753,
    "nmol/L": 8753,
    "g/dL": 8713,
    "U/L": 8645,
    "/uL": 8647,
    "%": 8554,
    "log copies/mL": 8519,
    "mOsm/kg": 8720,
    "cells/µL": 8647,
    "copies/mL": 8519,
    "cells/uL": 8647,
    "/µL": 8647,
}

# Normality text (trimmed, upper case) to OMOP qualifier concept.
# LOW is reported under the NORMAL concept.
NORMAL_CONCEPT = 4124457
ABNORMAL_CONCEPT = 4135493
HIGH_CONCEPT = 4328749
NORMALITY_CONCEPTS = {
    "NORMAL": NORMAL_CONCEPT,
    "ABNORMAL": ABNORMAL_CONCEPT,
    "HIGH": HIGH_CONCEPT,
    "LOW": NORMAL_CONCEPT,
}

# Constant OMOP concepts of a laboratory measurement.
LAB_RESULT_TYPE_CONCEPT = 44818702
EQUALS_OPERATOR_CONCEPT = 4172703

# Test category by unit.
TEST_CATEGORIES = {
    "Chemistry": ("mg/dL", "mmol/L", "nmol/L", "g/dL"),
    "Enzymes": ("U/L",),
    "Hematology": ("cells/µL", "cells/uL", "/uL", "/µL"),
    "Virology": ("log copies/mL", "copies/mL"),
    "Osmolality": ("mOsm/kg",),
    "Percentage": ("%",),
}
OTHER_CATEGORY = "Other"

# Seed concepts (id, name, LOINC code) for an empty concept table.
SEED_CONCEPTS = (
    (3013682, "Glucose [Mass/volume] in Serum or Plasma", "2345-7"),
    (3004249, "Cholesterol [Mass/volume] in Serum or Plasma", "2093-3"),
    (3024561, "Hemoglobin [Mass/volume] in Blood", "718-7"),
    (3013721, "Creatinine [Mass/volume] in Serum or Plasma", "2160-0"),
    (
        3006923,
        "Alanine aminotransferase [Enzymatic activity/volume] in Serum or Plasma",
        "1742-6",
    ),
)
