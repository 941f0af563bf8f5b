"""Hierarchical fall-back lookups into profile and constraint tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# level -> keys, most specific first
PROFILE_CHAIN = (
    ("SBU_CONTRACT", ("sbu", "contract_bucket")),
    ("SBU_SIZE", ("sbu", "size_category")),
    ("SBU_ASSET", ("sbu", "asset")),
    ("SBU", ("sbu",)),
    ("GLOBAL", ()),
)
CONSTRAINT_CHAIN = (
    ("SOW_SBU", ("sbu", "sow")),
    ("SOW_TYPE", ("sow",)),
    ("SBU_CONTRACT", ("sbu", "contract_bucket")),
    ("SBU_SIZE", ("sbu", "size_category")),
    ("SBU", ("sbu",)),
    ("GLOBAL", ()),
)
ALWAYS = ("SBU", "GLOBAL")


def lookups(
    rows: DataFrame,
    table: DataFrame,
    wanted: Mapping[str, tuple[str, Sequence[str]]],
    *,
    chain: Sequence[tuple[str, Sequence[str]]] = PROFILE_CHAIN,
    count: str | None = "n",
    min_n: int = 5,
    always: Sequence[str] = ALWAYS,
    extra_keys: Sequence[str] = (),
    read: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """For each prefix its field's values at the first level of the chain that has a usable row, and that level (`<prefix>level_used`).

    Levels below `min_n` are passed over, except the ones in `always`. The table is read once for all levels and fields, as one
    row per (level, key). The rows are read once too, and not dealt anew: they meet these few rows once for each level, and per field the first
    level that answers is kept. `read` turns each value taken into another, once per (level, key).
    """
    levels = [(lv, [*keys, *extra_keys]) for lv, keys in chain]
    levels = [(lv, keys) for lv, keys in levels if set(keys) <= set(rows.columns) and set(keys) <= set(table.columns)]

    def key(level: str, keys: Sequence[str]) -> Column:
        """NULL where a key is: it matches nothing."""
        return F.concat(F.lit(level), *[x for k in keys for x in (F.lit("\x1f"), F.col(k).cast("string"))])

    enough = F.col("level").isin(*always) | (F.col(count) >= min_n) if count else F.lit(True)
    keyed = F.coalesce(*[F.when(F.col("level") == lv, key(lv, keys)) for lv, keys in levels])
    take = list(dict.fromkeys(c for _, cs in wanted.values() for c in cs))
    usable = table.filter(F.col("field").isin(*{f for f, _ in wanted.values()}) & F.col("level").isin(*[lv for lv, _ in levels]) & enough)
    answers = usable.select("field", keyed.alias("__key"), *take).filter("__key IS NOT NULL").groupBy("__key").agg(
        *[F.max(F.when(F.col("field") == f, F.struct(*cs))).alias(f"__v_{p}") for p, (f, cs) in wanted.items()]
    )
    if read:
        for p, (_, cs) in wanted.items():
            v = F.col(f"__v_{p}")
            answers = answers.withColumn(f"__v_{p}", F.when(v.isNotNull(), F.struct(*[read(v[c]).alias(c) for c in cs])))

    out, found = rows, {p: [] for p in wanted}
    for i, (lv, keys) in enumerate(levels):
        if keys:
            mine = answers.select(F.col("__key").alias(f"__k{i}"), *[F.col(f"__v_{p}").alias(f"__v{i}_{p}") for p in wanted])
            out = out.join(mine, key(lv, keys) == F.col(f"__k{i}"), "left")
            values = {p: F.col(f"__v{i}_{p}") for p in wanted}
        else:
            one = answers.filter(F.col("__key") == lv).agg(F.first(F.struct(*[f"__v_{p}" for p in wanted]))).scalar()
            values = {p: one[f"__v_{p}"] for p in wanted}
        for p in wanted:
            found[p].append((lv, values[p]))
    columns = []
    for p, (_, cs) in wanted.items():
        best = F.coalesce(*[v for _, v in found[p]])
        columns += [best[c].alias(f"{p}{c}") for c in cs]
        columns.append(F.coalesce(*[F.when(v.isNotNull(), lv) for lv, v in found[p]]).alias(f"{p}level_used"))
    return out.select(*rows.columns, *columns)


def fallback(rows: DataFrame, table: DataFrame, field: str, take: Sequence[str], *, prefix: str = "", **rules) -> DataFrame:
    """`lookups` of one field."""
    return lookups(rows, table, {prefix: (field, take)}, **rules)


def fallback_bounds(
    rows: DataFrame,
    constraints: DataFrame,
    field: str,
    *,
    chain: Sequence[tuple[str, Sequence[str]]] = CONSTRAINT_CHAIN,
    out: str = "bounds",
) -> DataFrame:
    """As `fallback`, for `bounds_json`: a map<string,double>, empty when nothing matches or parses."""
    got = fallback(
        rows, constraints, field, ["bounds_json"], chain=chain, count=None, prefix=f"{out}_", read=lambda text: F.from_json(text, "map<string,double>")
    )
    empty = F.create_map().cast("map<string,double>")
    return got.withColumn(out, F.coalesce(f"{out}_bounds_json", empty)).drop(f"{out}_bounds_json")


def pair_or_general(rows: DataFrame, pairs: DataFrame, keys: Sequence[str], take: Sequence[str], general: Mapping[str, object]) -> DataFrame:
    """Values of the pair's own row, else the general ones."""
    per_pair = pairs.select(*keys, *[F.col(c).alias(f"__p_{c}") for c in take])
    out = rows.join(per_pair, list(keys), "left")
    return out.select(*rows.columns, *[F.coalesce(F.col(f"__p_{c}"), general[c]).alias(c) for c in take])
