"""Column cleaning: dates, guarded ratios, spans, vocabularies, keys."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import values


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# dates and spans


def dates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.to_date(n) for n in names})


def repair_end(start, end) -> Column:
    """An end before its start becomes the start; NULL sides are left alone."""
    s, e = col(start), col(end)
    return F.when(e < s, s).otherwise(e)


def span_days(start, end) -> Column:
    return F.datediff(col(end), col(start))


def span_days_if(start, end) -> Column:
    """Span only where the end exists."""
    return F.when(col(end).isNotNull(), F.datediff(col(end), col(start)))


def lifecycle_percent(event, start, duration, digits: int | None = None) -> Column:
    pct = F.when(col(duration) > 0, F.datediff(col(event), col(start)) * F.lit(100.0) / col(duration))
    return F.round(pct, digits) if digits is not None else pct


def lifecycle_share(event, start, end) -> Column:
    """Whole months since start over whole months of the span, clipped to [0, 1]."""
    month = F.round(F.months_between(col(event), col(start)), 0)
    total = F.greatest(F.months_between(col(end), col(start)).cast("int"), F.lit(1))
    share = month / total
    return F.when(share < 0, 0.0).when(share > 1, 1.0).otherwise(share)


def span_position(event, start, duration, digits: int = 3) -> Column:
    return F.round(
        F.when(col(duration) > 0, F.datediff(col(event), col(start)) / col(duration).cast("double")), digits
    )


# numbers


def ratio(num, den) -> Column:
    """NULL unless the denominator is positive."""
    return F.when(col(den) > 0, col(num) / col(den))


def cast_floor(x, dtype: str, floor, default=None) -> Column:
    """Cast, fill NULL with a default when one is given, and lift values below the floor."""
    v = col(x).cast(dtype)
    if default is not None:
        v = F.coalesce(v, F.lit(default).cast(dtype))
    return F.when(v < floor, F.lit(floor).cast(dtype)).otherwise(v)


def index_factor(
    year, index: Mapping[int, float] | None = None, base_year: int = values.COST_INDEX_BASE_YEAR
) -> Column:
    """Index of a year over the base year; unknown years count as the base."""
    table = dict(index or values.COST_INDEX)
    base = table[base_year]
    lookup = F.create_map(*[F.lit(v) for kv in sorted(table.items()) for v in kv])
    return F.coalesce(F.try_element_at(lookup, col(year).cast("int")), F.lit(base)) / F.lit(base)


def log_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    out = {f"log_{n}": F.log(F.greatest(F.col(n), F.lit(1.0))) for n in names}
    out |= {f"log1p_{n}": F.log1p(F.greatest(F.col(n), F.lit(0.0))) for n in names}
    return df.withColumns(out)


# row rules


def universe(
    df: DataFrame,
    *,
    latest: str | None = None,
    amount: str | None = None,
    min_amount: float | None = None,
    start: str | None = None,
    start_year: int | None = None,
    required: Sequence[str] = (),
    end: str | None = None,
    longer_than: int | None = None,
) -> DataFrame:
    """Quality filter of the source entities. The year rule is a date range, so it reaches the scan."""
    if latest:
        df = df.filter(F.col(latest))
    if amount and min_amount is not None:
        df = df.filter(F.col(amount) >= min_amount)
    if start and start_year is not None:
        df = df.filter(F.col(start) >= F.lit(f"{start_year}-01-01").cast(df.schema[start].dataType))
    for name in required:
        df = df.filter(F.col(name).isNotNull())
    if start and end and longer_than is not None:
        df = df.filter(span_days(start, end) > longer_than)
    return df


def missing_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({f"is_{n}_missing": F.col(n).isNull() for n in names})


def validity(df: DataFrame, rules: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Rows stay; flag -> (column, minimum) says whether the value is usable."""
    return df.withColumns(
        {flag: F.coalesce(F.col(c) >= floor, F.lit(False)) for flag, (c, floor) in rules.items()}
    )


def validity_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """All invalid counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(~F.col(f)).alias(f"n_not_{f}") for f in flags],
    )


# vocabularies


def canonical_by_prefix(x, prefixes: Mapping[str, str], null_to: str = "other") -> Column:
    v = F.lower(F.trim(col(x)))
    out = F.when(col(x).isNull(), null_to)
    for prefix, label in prefixes.items():
        out = out.when(F.lower(col(x)).startswith(prefix), label)
    return out.otherwise(v)


def simple_status(x, closed: Iterable[str] = values.CLOSED_STATUSES) -> Column:
    v = F.lower(col(x))
    return F.when(v.isin(*closed), "closed").when(v == "draft", "draft").otherwise("open")


def code_prefix(x, sep: str = " - ") -> Column:
    return F.trim(F.split_part(col(x), F.lit(sep), F.lit(1)))


def label(x) -> Column:
    return F.upper(F.trim(col(x)))


def keep_listed(df: DataFrame, out: str, expr: Column, allowed: Iterable[str]) -> DataFrame:
    return df.withColumn(out, expr).filter(F.col(out).isin(*allowed))


def usable_code(
    x,
    pattern: str = values.CODE_PATTERN,
    forbidden: str = values.CODE_FORBIDDEN,
    max_length: int = values.CODE_MAX_LENGTH,
) -> Column:
    v = col(x)
    return v.rlike(pattern) & (F.length(v) <= max_length) & ~v.rlike(forbidden)


def phase_of(code, phases: Mapping[str, Sequence[str]] | None = None) -> Column:
    """First phase owning a prefix of the code."""
    out = None
    for phase, prefixes in (phases or values.PHASE_PREFIXES).items():
        hit = F.lit(False)
        for p in prefixes:
            hit = hit | col(code).startswith(p)
        out = F.when(hit, phase) if out is None else out.when(hit, phase)
    return out.otherwise("unknown")


# schemas and keys


def pad(df: DataFrame, schema: Mapping[str, str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly the named columns: rename first, then fill the absent ones with typed NULLs."""
    have = set(df.columns)
    for old, new in (renames or {}).items():
        if old in have and new not in have:
            df = df.withColumnRenamed(old, new)
            have = (have - {old}) | {new}
    return df.select(
        *[
            F.col(n).cast(t).alias(n) if n in have else F.lit(None).cast(t).alias(n)
            for n, t in schema.items()
        ]
    )


def drop_shadowed(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the columns that the other side of a join is the authority for."""
    return df.drop(*[c for c in df.columns if c in set(other.columns) - set(keys)])


def short_code(x, length: int = 3, default: str = "GEN") -> Column:
    v = F.upper(F.substring(F.regexp_replace(col(x), "[^A-Za-z0-9]", ""), 1, length))
    return F.when(v.isNull() | (v == ""), default).otherwise(v)


def zero_filled(x, width: int) -> Column:
    """Digits with leading zeros; longer numbers stay whole."""
    v = col(x).cast("string")
    return F.when(F.length(v) < width, F.lpad(v, width, "0")).otherwise(v)


def readable_key(prefix: str, group, number, width: int = 6) -> Column:
    return F.concat_ws("-", F.lit(prefix), short_code(group), zero_filled(number, width))


def version_code(entity, version, baseline: int = 0) -> Column:
    """`<entity>-000.01-BL` for the baseline, `<entity>-00n.MO-RB` after it."""
    e, v = col(entity).cast("string"), col(version)
    return F.when(v == baseline, F.concat(e, F.lit("-000.01-BL"))).otherwise(
        F.concat(e, F.lit("-"), zero_filled(v, 3), F.lit(".MO-RB"))
    )


def fingerprint(names: Sequence[str], length: int = 12) -> Column:
    """md5 over the JSON of the named columns in name order."""
    return F.substring(F.md5(F.to_json(F.struct(*[F.col(n) for n in sorted(names)]))), 1, length)
