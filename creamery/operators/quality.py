"""Named data-quality expectations attached to a table.

A rule is a SQL predicate plus an action: ``warn`` keeps every row and counts
the violations, ``drop`` removes violating rows. A row violates a rule when
the predicate is not TRUE (FALSE or NULL).

Counting uses ``DataFrame.observe``: the metrics are computed as part of the
job that writes the table (no second pass), are reported once per query even
when tasks are retried (unlike accumulators), and work unchanged on a
streaming DataFrame, where they arrive in ``StreamingQueryProgress.observedMetrics``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP):
            raise ValueError(f"unknown action {self.action!r} for expectation {self.name!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def violated(self) -> Column:
        return ~self.holds()


# The rules of the bronze layer.
VALID_PLANT_ID = Expectation("valid_plant_id", "plant_id IS NOT NULL", WARN)
VALID_BATCH_ID = Expectation("valid_batch_id", "batch_id IS NOT NULL", WARN)
VALID_READING_ID = Expectation("valid_reading_id", "reading_id IS NOT NULL", WARN)
PLAUSIBLE_TEMPERATURE = Expectation("plausible_temperature", "temperature_c BETWEEN -20 AND 150", DROP)

BRONZE_RULES = {
    "dim_plants": (VALID_PLANT_ID,),
    "historical_production_batches": (VALID_BATCH_ID,),
    "sensor_readings_stream": (VALID_READING_ID, PLAUSIBLE_TEMPERATURE),
}


def _metric_columns(expectations: Sequence[Expectation], extra: dict | None = None) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("records")]
    cols += [F.count_if(e.violated()).alias(e.name) for e in expectations]
    cols += [expr.alias(name) for name, expr in (extra or {}).items()]
    return cols


def apply_expectations(
    df: DataFrame,
    expectations: Sequence[Expectation],
    observation: Observation | str | None = None,
    extra_metrics: dict[str, Column] | None = None,
) -> DataFrame:
    """Count violations of every rule, then remove rows failing ``drop`` rules.

    ``observation`` is an :class:`Observation` (batch: read ``.get`` after the
    write) or a name (streaming: one set of counts a micro-batch). The counts are
    taken *before* any row is dropped, so they describe the input.
    ``extra_metrics`` are further named aggregate columns observed alongside.
    """
    if not expectations:
        return df
    out = df
    if observation is not None:
        out = out.observe(observation, *_metric_columns(expectations, extra_metrics))
    keep = None
    for e in expectations:
        if e.action == DROP:
            keep = e.holds() if keep is None else keep & e.holds()
    return out if keep is None else out.filter(keep)


def expectations_report(df: DataFrame, table_name: str, expectations: Sequence[Expectation]) -> DataFrame:
    """Passed / failed counts per rule, one row per rule, in a single scan.

    Columns: table_name, rule_name, action, total_records, failed_records,
    passed_records. One global aggregate (partial counts per task, one tiny
    final merge) followed by ``stack`` to turn the rule columns into rows.
    """
    totals = df.agg(*_metric_columns(expectations))
    pieces = ", ".join(f"'{e.name}', '{e.action}', `{e.name}`" for e in expectations)
    long = totals.selectExpr(
        "records AS total_records",
        f"stack({len(expectations)}, {pieces}) AS (rule_name, action, failed_records)",
    )
    return long.select(
        F.lit(table_name).alias("table_name"),
        "rule_name",
        "action",
        "total_records",
        "failed_records",
        (F.col("total_records") - F.col("failed_records")).alias("passed_records"),
    )
