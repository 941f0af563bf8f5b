"""Root-entity generator: quotas, a Gaussian-copula draw per group, a correlated field chain, rules.

Replaces a deep tabular model: margins are quantile grids of the real rows, dependence is the
correlation of their normal scores, and every synthetic row is a pure function of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import clean, draws, values
from sigloom.operators.aggregates import pmf, quotas
from sigloom.operators.ordered import ordered, written
from sigloom.operators.quantiles import exact_quantiles
from sigloom.session import cut_lineage

GRID = 200
CHUNK = 2_000


def expand(df: DataFrame, n: Column, out: str, chunk: int = CHUNK) -> DataFrame:
    """n rows per input row, made in chunks that are spread over the cluster first."""
    total = df.withColumn("__total", n.cast("long")).filter("__total > 0")
    chunks = total.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__total") - 1) / chunk))))
    # one row per chunk is moved, never the generated rows; a given number, as the few bytes would be put into one partition
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(parts, *[c for c in df.columns if dict(df.dtypes)[c] in ("string", "bigint", "int")], "__chunk")
    first = F.col("__chunk") * chunk + 1
    last = F.least(F.col("__total"), (F.col("__chunk") + 1) * chunk)
    return spread.withColumn(out, F.explode(F.sequence(first, last))).drop("__total", "__chunk")


def grids(real: DataFrame, group: str, fields: Sequence[str], accuracy: int = 20_000) -> DataFrame:
    """Quantile grid of each field per group: one bounded sketch each."""
    ps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return real.groupBy(group).agg(*[F.percentile_approx(F.col(f).cast("double"), ps, accuracy).alias(f"__g_{f}") for f in fields])


def _score(grid: Column, x: Column) -> Column:
    """Normal score of the number of grid points up to x, by binary search in the ascending grid."""

    def search(passed: Column, step: Column) -> Column:
        reached = passed + step
        return F.when((reached <= F.size(grid)) & (F.get(grid, reached - 1) <= x), reached).otherwise(passed)

    steps = [1 << b for b in reversed(range((GRID + 1).bit_length()))]
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search)
    return draws.probit((below - 0.5) / float(GRID + 1))


def correlations(real: DataFrame, grid: DataFrame, group: str, fields: Sequence[str]) -> DataFrame:
    """Correlation of normal scores, one column per pair of fields."""
    df = real.select(group, *[F.col(f).cast("double").alias(f) for f in fields]).dropna().join(grid, group)
    df = df.select(group, *[_score(F.col(f"__g_{f}"), F.col(f)).alias(f) for f in fields])
    pairs = [(i, j) for i in range(len(fields)) for j in range(i)]
    return df.groupBy(group).agg(
        *[F.coalesce(F.nanvl(F.corr(fields[i], fields[j]), F.lit(0.0)), F.lit(0.0)).alias(f"__r_{i}_{j}") for i, j in pairs]
    )


def with_factor(corr: DataFrame, k: int, shrink: float = 0.98) -> DataFrame:
    """Cholesky factor of the correlation columns as columns `__l_i_j`, one step at a time.

    Runs on one row per group; slight shrinkage keeps the matrix positive definite.
    """
    for i in range(k):
        for j in range(i + 1):
            r = F.lit(1.0) if i == j else F.col(f"__r_{i}_{j}") * shrink
            for m in range(j):
                r = r - F.col(f"__l_{i}_{m}") * F.col(f"__l_{j}_{m}")
            entry = F.sqrt(F.greatest(r, F.lit(1e-9))) if i == j else r / F.col(f"__l_{j}_{j}")
            corr = corr.withColumn(f"__l_{i}_{j}", entry)
    return corr.drop(*[f"__r_{i}_{j}" for i in range(k) for j in range(i)])


def _from_grid(grid: Column, u: Column) -> Column:
    """Linear interpolation on the quantile grid."""
    pos = F.least(F.greatest(u, F.lit(0.0)), F.lit(1.0)) * GRID
    i = F.least(F.floor(pos), F.lit(GRID - 1)).cast("int")
    a, b = F.element_at(grid, i + 1), F.element_at(grid, i + 2)
    return a + (b - a) * (pos - i)


def sample_entities(
    real: DataFrame, total: int, *, group: str = "sbu", fields: Sequence[str], categories: Sequence[str] = (), oversample: int = 2, seed: int = draws.SEED
) -> DataFrame:
    """Copula draw of `oversample` times the quota of each group; `quota` and `draw` ride along.

    Grids and model are written: the planner sees that a row a group is little, and rows are not dealt by their few groups.
    """
    q = quotas(real, group, total)
    grid = written(grids(real, group, fields))
    factor = with_factor(correlations(real, grid, group, fields), len(fields))
    model = q.join(grid, group).join(factor, group)
    for c in categories:
        shares = pmf(real, [group], c).groupBy(group).agg(F.sort_array(F.collect_list(F.struct(c, "prob"))).alias(f"__c_{c}"))
        model = model.join(shares, group)
    model = written(model)
    rows = expand(model.select(group, "quota"), F.col("quota") * oversample, "draw")
    # each row's group is in the model; a left join, as the planner sizes the rows by their chunks and would send them round
    df = rows.join(model.drop("quota", "n_real"), group, "left")
    key = [group, "draw"]
    z = [draws.normal(key, f"copula:{f}", seed=seed) for f in fields]
    df = df.withColumns({f"__z_{i}": zi for i, zi in enumerate(z)})
    out = {}
    for i, f in enumerate(fields):
        mixed = sum((F.col(f"__l_{i}_{j}") * F.col(f"__z_{j}") for j in range(1, i + 1)), F.col(f"__l_{i}_0") * F.col("__z_0"))
        df = df.withColumn(f"__m_{i}", mixed).withColumn(f"__u_{i}", draws.normal_cdf(F.col(f"__m_{i}")))
        out[f] = _from_grid(F.col(f"__g_{f}"), F.col(f"__u_{i}"))
    for c in categories:
        arr = F.col(f"__c_{c}")
        out[c] = draws.categorical(draws.uniform(key, f"cat:{c}", seed=seed), F.transform(arr, lambda x: x[c]), F.transform(arr, lambda x: x["prob"]))
    return df.select(group, "draw", "quota", *[v.alias(k) for k, v in out.items()])


STATS_FIELDS = ("n_floors", "gross_area", "amt_contract", "amt_cost")


def field_stats(real: DataFrame, group: str = "sbu") -> DataFrame:
    """Quartiles of area per floor, contract per area and cost per contract, bounds, and the floor PMF.

    The rows are computed once for all of them, and so are the statistics for all that read them.
    """
    return _field_stats(written(real.select(group, *STATS_FIELDS)), group)


def _field_stats(real: DataFrame, group: str) -> DataFrame:
    ratios = {"apf": F.col("gross_area") / F.col("n_floors"), "cps": F.col("amt_contract") / F.col("gross_area"), "rat": F.col("amt_cost") / F.col("amt_contract")}
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("m"), r.alias("x")) for m, r in ratios.items()]))
    df = real.filter("gross_area > 0 AND n_floors > 0 AND amt_contract > 0 AND amt_cost > 0").select(group, each)
    parts = exact_quantiles(df, [group, "m"], "x", {"lo": 0.25, "mid": 0.5, "hi": 0.75})
    out = parts.groupBy(group).agg(*[F.max(F.when(F.col("m") == m, F.col(e))).alias(f"{m}_{e}") for m in ratios for e in ("lo", "mid", "hi")])
    out = out.dropna(subset=[f"{m}_mid" for m in ratios])
    edge = real.groupBy(group).agg(
        *[F.percentile_approx(F.col(f).cast("double"), F.array(F.lit(0.01), F.lit(0.99)), 10_000).alias(f"{f}_b") for f in STATS_FIELDS]
    )
    floors = pmf(real, [group], "n_floors").groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_floors").cast("int"), "prob"))).alias("floor_pmf"))
    return written(out.join(edge, group).join(floors, group))


def with_overall(rows: DataFrame, stats: DataFrame, group: str) -> DataFrame:
    """Rows with their group's statistics; those of all groups together where there are none."""
    middles = [f"{m}_{e}" for m in ("apf", "cps", "rat") for e in ("lo", "mid", "hi")]
    bounds = ["n_floors_b", "gross_area_b", "amt_contract_b", "amt_cost_b"]
    n = stats.agg(F.count(F.lit(1))).scalar()
    shares = stats.select(F.explode("floor_pmf").alias("k", "p")).groupBy("k").agg((F.sum("p") / n).alias("p"))
    floors = shares.agg(F.map_from_entries(F.collect_list(F.struct("k", "p")))).scalar()
    every = stats.agg(*[F.avg(c).alias(c) for c in middles], *[F.array(F.min(F.col(c)[0]), F.max(F.col(c)[1])).alias(c) for c in bounds]).withColumn("floor_pmf", floors)
    every = every.withColumn("__unit", F.lit(None).cast(stats.schema[group].dataType))
    both = stats.withColumnRenamed(group, "__unit").unionByName(every)
    unit = rows.join(stats.select(F.col(group).alias("__known")), F.col(group) == F.col("__known"), "left")
    return unit.join(both, F.col("__known").eqNullSafe(F.col("__unit"))).drop("__known", "__unit")


def field_chain(rows: DataFrame, stats: DataFrame, key: Sequence[str], group: str = "sbu", capped_unit: str = "mission critical", cap: int = 3) -> DataFrame:
    """Floors -> area -> contract -> cost, each drawn around its group's ratio and softly bounded.

    Rows of a group that `stats` doesn't know, or of none, are drawn by the mean of all groups, within their widest bounds.
    """
    df = with_overall(rows, stats, group)
    u = lambda p: draws.uniform(key, p)
    capped = F.lower(F.trim(F.col(group))) == capped_unit
    lo, hi = F.floor(F.col("n_floors_b")[0]), F.ceil(F.col("n_floors_b")[1])
    redraw = (F.col("n_floors") < lo) | (F.col("n_floors") > hi) | (u("floors:redraw") < 0.50)
    floors = F.when(redraw, draws.smoothed_pmf(u("floors"), F.col("floor_pmf"), lo, hi)).otherwise(F.round("n_floors")).cast("int")
    floors = F.greatest(F.lit(1), F.when(capped, F.least(floors, F.lit(cap))).otherwise(floors))

    def around(m: str, widen: float) -> Column:
        return draws.triangular(u(m), F.col(f"{m}_lo") * (1 - widen), F.col(f"{m}_mid"), F.col(f"{m}_hi") * (1 + widen))

    def soft(x: Column, f: str, jitter: float) -> Column:
        return draws.soft_range(x, F.col(f"{f}_b")[0], F.col(f"{f}_b")[1], key, f"soft:{f}", jitter=jitter)

    df = df.withColumn("n_floors", floors)
    area = F.when(F.col("gross_area").isNull() | (u("area:redraw") < 0.55), around("apf", 0.12) * F.col("n_floors")).otherwise(F.col("gross_area"))
    df = df.withColumn("__x", area)
    df = df.withColumn("gross_area", F.round(F.greatest(soft(F.col("__x"), "gross_area", 0.06), F.lit(1.0)), 2))
    df = df.withColumn("__x", around("cps", 0.15) * F.col("gross_area"))
    df = df.withColumn("amt_contract", soft(F.col("__x"), "amt_contract", 0.05))
    rat = F.least(F.greatest(around("rat", 0.06), F.lit(values.RATIO_BAND[0])), F.lit(values.RATIO_BAND[1]))
    df = df.withColumn("__x", F.col("amt_contract") * rat)
    df = df.withColumn("amt_cost", soft(F.col("__x"), "amt_cost", 0.05)).drop("__x")
    return df.drop(*[c for c in stats.columns if c != group])


def business_rules(df: DataFrame, key: Sequence[str], *, group: str = "sbu", capped_unit: str = "mission critical", cap: int = 3, noise: bool = True) -> DataFrame:
    """Hard rules of a generated row; `noise=False` leaves only the deterministic part."""
    capped = F.lower(F.trim(F.col(group))) == capped_unit
    floors = F.greatest(F.lit(1), F.round(F.coalesce(F.col("n_floors"), F.lit(1))).cast("int"))
    refill = F.greatest(F.exp(draws.normal(key, "area:refill", 6.9078, 0.75)), F.lit(1.0)) if noise else F.lit(1.0)
    ratio = F.col("amt_cost") / F.when(F.col("amt_contract") > 0, F.col("amt_contract"))
    pulled = (1.0 - values.RATIO_PULL) * F.coalesce(ratio, F.lit(values.RATIO_TARGET)) + values.RATIO_PULL * values.RATIO_TARGET
    if noise:
        pulled = pulled + draws.normal(key, "ratio:pull", 0.0, values.RATIO_SIGMA)
    clamped = F.least(F.greatest(pulled, F.lit(values.RATIO_BAND[0])), F.lit(values.RATIO_BAND[1]))
    return df.withColumns(
        {
            "dt_end": clean.repair_end("dt_start", "dt_end"),
            "n_floors": F.when(capped, F.least(floors, F.lit(cap))).otherwise(floors),
            "gross_area": F.round(F.when(F.col("gross_area") > 0, F.col("gross_area")).otherwise(refill), 2),
            "amt_contract": F.greatest(F.col("amt_contract"), F.lit(1.0)),
            "amt_cost": F.greatest(F.greatest(F.col("amt_contract"), F.lit(1.0)) * clamped, F.lit(1.0)),
            "inflation_factor": clean.index_factor(F.year("dt_start")),
        }
    )


def fill_quota(df: DataFrame, group: str = "sbu", draw: str = "draw", quota: str = "quota") -> DataFrame:
    """Rows without NULLs, in draw order, until the quota is full. Sliced, as a group may be huge."""
    got = ordered(df.dropna(), [group], [draw], row_number="__i")
    return got.filter(F.col("__i") <= F.col(quota)).drop("__i", quota)


def generate(real: DataFrame, total: int, start_year_grid: str = "start_day") -> DataFrame:
    """Complete root table: copula rows, field chain, rules, quota, readable keys.

    `real` has sbu, region, asset, n_floors, gross_area, amt_contract, amt_cost, dt_start, dt_end.
    """
    base = real.withColumns({"start_day": F.unix_date("dt_start").cast("double"), "duration": F.datediff("dt_end", "dt_start").cast("double")})
    base = written(base.filter("duration >= 0"))  # read for every statistic
    fields = ("gross_area", "amt_contract", "n_floors", "start_day", "duration")
    rows = sample_entities(base, total, fields=fields, categories=("region", "asset"))
    key = ["sbu", "draw"]
    start = F.date_from_unix_date(F.round("start_day").cast("int"))
    rows = rows.withColumns({"dt_start": start, "dt_end": F.date_add(start, F.round("duration").cast("int"))}).drop("start_day", "duration")
    rows = business_rules(field_chain(rows, _field_stats(base, "sbu"), key), key).drop("inflation_factor")
    rows = fill_quota(cut_lineage(rows))  # the quota looks at the rows more than once
    rows = rows.withColumn("entity_id", clean.readable_key("SYN", "sbu", "draw"))
    cols = ("entity_id", "sbu", "region", "asset", "n_floors", "gross_area", "amt_contract", "amt_cost", "dt_start", "dt_end")
    return rows.select(*[F.round(c, 2).alias(c) if c.startswith("amt") else F.col(c) for c in cols])
