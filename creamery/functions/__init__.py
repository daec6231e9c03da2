"""Column-level helpers (casts, measures, note scoring)."""

from creamery.functions.casts import to_double, to_int, to_timestamp
from creamery.functions.measures import count_when, safe_pct, yield_pct
from creamery.functions.sentiment import DEFAULT_RULES, Rule, model_scorer, rules_scorer, with_sentiment

__all__ = [
    "to_int", "to_double", "to_timestamp",
    "safe_pct", "yield_pct", "count_when",
    "Rule", "DEFAULT_RULES", "rules_scorer", "model_scorer", "with_sentiment",
]
