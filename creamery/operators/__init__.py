"""DataFrame -> DataFrame operators (dedup, expectations, joins, harmonise)."""

from creamery.operators.dedup import dedup_by_key
from creamery.operators.harmonise import harmonise_sensor, union_sources
from creamery.operators.joins import anti_join_null_safe, join_dim
from creamery.operators.quality import (
    BRONZE_RULES,
    DROP,
    PLAUSIBLE_TEMPERATURE,
    VALID_BATCH_ID,
    VALID_PLANT_ID,
    VALID_READING_ID,
    WARN,
    Expectation,
    apply_expectations,
    expectations_report,
)

__all__ = [
    "dedup_by_key", "harmonise_sensor", "union_sources", "anti_join_null_safe", "join_dim",
    "Expectation", "apply_expectations", "expectations_report", "BRONZE_RULES", "WARN", "DROP",
    "VALID_PLANT_ID", "VALID_BATCH_ID", "VALID_READING_ID", "PLAUSIBLE_TEMPERATURE",
]
