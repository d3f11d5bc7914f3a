from labmart.plans.flows import (
    bronze_to_enhanced,
    bronze_to_silver,
    csv_to_bronze,
    enhanced_bucket,
    load_vocabularies,
    silver_to_gold,
    validate_silver,
)

__all__ = [
    "bronze_to_enhanced",
    "bronze_to_silver",
    "csv_to_bronze",
    "enhanced_bucket",
    "load_vocabularies",
    "silver_to_gold",
    "validate_silver",
]
