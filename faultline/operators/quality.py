"""Data-quality gate: rules as data, one report row per rule."""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import nan_to_null
from faultline.operators.cleaning import typed
from faultline.operators.profile import duplicate_keys, is_missing
from faultline.schemas import CLEAN_COLUMNS


@dataclass(frozen=True)
class Rules:
    """What a table has to satisfy. Empty fields are not checked."""

    expected_rows: int | None = None
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    classes: dict[str, Sequence[int]] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    not_empty: bool = False


# Gate of the cleaned sensor table.
SENSOR_RULES = Rules(
    not_null=("udi", "type", "machine_failure"),
    unique=("udi",),
    classes={"machine_failure": (0, 1)},
    ranges={"air_temperature_k": (200.0, 400.0)},
)


class QualityError(ValueError):
    """A rule of severity ``error`` failed."""


def quality_report(
    df: DataFrame, rules: Rules, had_value: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows (check, column, value, passed, severity).

    Everything but the duplicate check is one scan with one aggregate; the
    duplicate check adds one grouped scan of the key columns. ``had_value``
    tells for typed columns whether the field they were read from was filled:
    what is null all the same was lost by the cast.
    """
    entries = []

    def add(check, name, value, passed, severity):
        entries.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(name).alias("column"),
                value.cast("double").alias("value"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                F.lit(severity).alias("severity"),
            )
        )

    rows = F.count("*")
    if rules.expected_rows is not None:
        add("row_count", "*", rows, rows == rules.expected_rows, "error")
    if rules.not_empty:
        add("not_empty", "*", rows, rows > 0, "error")
    for name in rules.not_null:
        nulls = F.count_if(is_missing(df, name))
        add("not_null", name, nulls, nulls == 0, "error")
    if rules.unique:
        keys = list(rules.unique)
        repeated = duplicate_keys(df.select(*keys), *keys).agg(F.count("*")).scalar()
        # an aggregate around the scalar keeps it legal next to the others
        repeated = F.coalesce(F.max(repeated), F.lit(0))
        add("unique", ",".join(keys), repeated, repeated == 0, "error")
    for name, values in rules.classes.items():
        for value in values:
            seen = F.count_if(F.col(name) == value)
            add("class_present", f"{name}={value}", seen, seen > 0, "error")
    for name, (low, high) in rules.ranges.items():
        smallest, largest = F.min(nan_to_null(name)), F.max(nan_to_null(name))
        add("range_low", name, smallest, smallest >= F.lit(low), "warn")
        add("range_high", name, largest, largest <= F.lit(high), "warn")
    for name, had in (had_value or {}).items():
        lost = F.count_if(had & is_missing(df, name))
        add("lost_by_cast", name, lost, lost == 0, "warn")
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def typed_report(
    raw: DataFrame, rules: Rules, columns: Sequence[tuple[str, str]] = CLEAN_COLUMNS
) -> DataFrame:
    """``quality_report`` of the typed rows and their cast losses, together: each
    field is cast once, in one scan of the raw rows besides the duplicate check."""
    filled = {name: F.col(f"_had_{name}") for name, _ in columns}
    both = raw.select(
        *[typed(name, kind) for name, kind in columns],
        *[F.col(name).isNotNull().alias(f"_had_{name}") for name in filled],
    )
    return quality_report(both, rules, filled)


def cast_loss_report(losses: DataFrame) -> DataFrame:
    """Quality rows from ``cleaning.cast_losses``."""
    return losses.select(
        F.lit("lost_by_cast").alias("check"),
        "column",
        F.col("lost").cast("double").alias("value"),
        (F.col("lost") == 0).alias("passed"),
        F.lit("warn").alias("severity"),
    )


def missed_failures_report(cells: DataFrame) -> DataFrame:
    """Warning row when a model missed failures."""
    return cells.select(
        F.lit("missed_failures").alias("check"),
        F.lit("prediction").alias("column"),
        F.col("fn").cast("double").alias("value"),
        (F.col("fn") == 0).alias("passed"),
        F.lit("warn").alias("severity"),
    )


def enforce(report: DataFrame) -> list:
    """Raise on failed ``error`` rows; return the failed warnings.

    The report has one row per rule, so collecting it is bounded.
    """
    failed = report.filter(~F.col("passed")).collect()
    errors = [r for r in failed if r["severity"] == "error"]
    if errors:
        text = "; ".join(f"{r['check']}({r['column']})={r['value']}" for r in errors)
        raise QualityError(f"data-quality gate failed: {text}")
    return failed
