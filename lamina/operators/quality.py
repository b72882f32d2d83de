"""Threshold checks on a table: one aggregate for all checks, one row per check."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.columns import moment

# Rules are SQL aggregate expressions: a table's checks go to Spark as one text
# instead of hundreds of small calls.


def _percent(hits: str, base: str) -> str:
    """100 * hits / base; an empty base gives 0.0 (and so fails its threshold)."""
    return f"coalesce(100.0D * {hits} / nullif({base}, 0), 0.0D)"


def _literal(value: str | int | float | None) -> str:
    if value is None:
        return "cast(null as string)"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value}D" if isinstance(value, float) else str(value)


def not_null(column: str) -> str:
    return _percent(f"count(`{column}`)", "count(1)")


def in_set(column: str, values: Iterable[str | int]) -> str:
    """Share of all rows whose value is in the set; NULL is a miss."""
    listed = ", ".join(map(_literal, values))
    return _percent(f"count_if(`{column}` in ({listed}))", "count(1)")


def gte_zero(column: str) -> str:
    """Share of the non-NULL values that are not negative."""
    return _percent(f"count_if(`{column}` >= 0)", f"count(`{column}`)")


def passed_rows() -> str:
    """Share of rows whose own status is PASS."""
    return _percent("count_if(_dq_status = 'PASS')", "count(1)")


@dataclass(frozen=True)
class Check:
    column: str | None  # None: a table-level check
    metric_type: str  # completeness | validity | accuracy | uniqueness
    measure: str
    threshold: float


def measure(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check, in check order: a single scan and a single aggregate."""
    values = df.agg(*[F.expr(c.measure).alias(f"_v{i}") for i, c in enumerate(checks)])
    rows = [
        f"struct({i + 1}L as id, {_literal(table)} as table_name, "
        f"{_literal(c.column)} as column_name, {_literal(c.metric_type)} as metric_type, "
        f"_v{i} as metric_value, {float(c.threshold)}D as threshold, "
        f"if(_v{i} >= {float(c.threshold)}D, 'PASSED', 'FAILED') as status)"
        for i, c in enumerate(checks)
    ]
    return values.selectExpr(f"inline(array({', '.join(rows)}))")


def log_rows(measured: DataFrame, run_id: str, checked_at: datetime) -> DataFrame:
    """Shape measured checks for the log."""
    return measured.select(
        "id",
        F.lit(run_id).alias("run_id"),
        "table_name", "column_name", "metric_type", "metric_value", "threshold", "status",
        moment(checked_at).alias("checked_at"),
    )
