"""Numeric profile and bounds of the root entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import clean
from sigloom.operators.aggregates import bounds_json
from sigloom.operators.levels import Level, level_keys, profile_fields
from sigloom.operators.quantiles import percents

FIELDS = (
    "duration_days", "n_floors", "gross_area", "amt_contract", "amt_cost",
    "cost_contract_ratio", "contract_per_area", "cost_per_area",
)
LEVELS = (Level("SBU", ("sbu",)), Level("SBU_ASSET", ("sbu", "asset"), 5, ("sbu", "asset")))
BOUNDS = percents("p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99")


def prepare(df: DataFrame) -> DataFrame:
    """Repair dates, lift values to their floors and derive the three ratios.

    Columns: dt_start, dt_end, n_floors, gross_area, amt_contract, amt_cost.
    """
    df = clean.dates(df, ["dt_start", "dt_end"])
    df = df.withColumn("dt_end", clean.repair_end("dt_start", "dt_end"))
    df = df.withColumns(
        {
            "duration_days": clean.span_days("dt_start", "dt_end"),
            "n_floors": clean.cast_floor("n_floors", "int", 1, default=1),
            "gross_area": clean.cast_floor("gross_area", "double", 1.0),
            "amt_contract": clean.cast_floor("amt_contract", "double", 0.0),
            "amt_cost": clean.cast_floor("amt_cost", "double", 0.0),
        }
    )
    return df.withColumns(
        {
            "cost_contract_ratio": clean.ratio("amt_cost", "amt_contract"),
            "contract_per_area": clean.ratio("amt_contract", "gross_area"),
            "cost_per_area": clean.ratio("amt_cost", "gross_area"),
        }
    )


def numeric_profile(
    df: DataFrame, levels: Sequence[Level] = LEVELS, fields: Sequence[str] = FIELDS, digits: int = 2
) -> DataFrame:
    """One row per level, group and field. One scan and one aggregate: levels are grouping sets."""
    out = profile_fields(df, levels, fields, percents("p1", "p5", "p25", "median", "p75", "p95", "p99"), ("min", "max", "mean", "stddev"))
    out = out.withColumn("pct_missing", F.round((F.col("n_total") - F.col("n_nonnull")) / F.col("n_total") * 100.0, 2))
    numeric = ("min", "p1", "p5", "p25", "median", "p75", "p95", "p99", "max", "mean", "stddev")
    return out.select(
        "level", *level_keys(levels), "field", "n_total", "n_nonnull", "pct_missing",
        *[F.round(c, digits).alias(c) for c in numeric],
    )


def bounds(df: DataFrame, levels: Sequence[Level] = LEVELS, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Nine quantiles, minimum and maximum of each field as a JSON map."""
    out = profile_fields(df, levels, fields, BOUNDS, ("min", "max"), count="n")
    names = {"min": "min", **{("p50" if n == "median" else n): n for n in BOUNDS}, "max": "max"}
    return out.select("level", *level_keys(levels), "field", "n", bounds_json(names).alias("bounds_json"))
