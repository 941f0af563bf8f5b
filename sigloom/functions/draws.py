"""Random draws as Column expressions.

Every draw hashes (seed, row key, purpose) with MD5, so a row gets the same value in any
partitioning, on any executor and on every retry. One purpose per draw.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sigloom.functions.clean import col

SEED = 42
_STEPS = 2**52


def uniform(keys: Sequence, purpose: str, low=0.0, high=1.0, seed: int = SEED) -> Column:
    """Uniform in the open interval, from the first 13 hex digits of the MD5 of `seed|keys|purpose`.

    Any engine with MD5 can repeat the draw (see `uniform_sql`).
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys], F.lit(purpose))
    u = of_text(text)
    return u if (isinstance(low, float) and isinstance(high, float) and (low, high) == (0.0, 1.0)) else (
        F.lit(low) + (F.lit(high) - F.lit(low)) * u
    )


def of_text(text: Column) -> Column:
    """The draw of a text `seed|keys|purpose`, for folds that add only the last keys to it."""
    h = F.conv(F.substring(F.md5(text), 1, 13), 16, 10)
    return (h.cast("double") + 0.5) / float(_STEPS)


def uniform_sql(keys: Sequence[str], purpose: str, seed: int = SEED) -> str:
    """The same draw as SQL text."""
    text = ", ".join([f"'{seed}'", *keys, f"'{purpose}'"])
    return f"((CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / {_STEPS})"


def normal_sql(keys: Sequence[str], purpose: str, seed: int = SEED) -> str:
    u, t = uniform_sql(keys, purpose + ":r", seed), uniform_sql(keys, purpose + ":t", seed)
    return f"(sqrt(-2 * ln({u})) * cos({2.0 * math.pi!r}::DOUBLE * {t}))"


def chance(keys, purpose: str, probability, seed: int = SEED) -> Column:
    return uniform(keys, purpose, seed=seed) < (probability if isinstance(probability, Column) else F.lit(probability))


def integer(keys, purpose: str, low, high, seed: int = SEED) -> Column:
    """Whole number in [low, high]."""
    lo, hi = F.lit(low) if not isinstance(low, Column) else low, F.lit(high) if not isinstance(high, Column) else high
    return (lo + F.floor(uniform(keys, purpose, seed=seed) * (hi - lo + 1))).cast("int")


def pick(keys, purpose: str, items: Sequence, seed: int = SEED) -> Column:
    arr = F.array(*[F.lit(i) for i in items])
    return F.element_at(arr, integer(keys, purpose, 1, len(items), seed=seed))


def normal(keys, purpose: str, mean=0.0, sd=1.0, seed: int = SEED) -> Column:
    """Box-Muller on two hash uniforms."""
    r = F.sqrt(-2.0 * F.log(uniform(keys, purpose + ":r", seed=seed)))
    z = r * F.cos(2.0 * math.pi * uniform(keys, purpose + ":t", seed=seed))
    return F.lit(mean) + F.lit(sd) * z


def triangular(u: Column, low, mode, high) -> Column:
    """Inverse CDF; a zero-width triangle returns its mode."""
    m = col(mode)
    a, b = F.least(col(low), m), F.greatest(col(high), m)
    width = b - a
    cut = (m - a) / width
    left = a + F.sqrt(u * width * (m - a))
    right = b - F.sqrt((1.0 - u) * width * (b - m))
    return F.when(width <= 0, m).when(u < cut, left).otherwise(right)


def from_bounds(keys, purpose: str, bounds: Mapping[str, Column | str], jitter: float = 0.05, seed: int = SEED) -> Column:
    """Triangular draw from p25 / median / p75 with jitter and a p95 cap.

    A side equal to the median is opened by half a unit, unless both are.
    """
    med = col(bounds["median"])
    lo, hi = F.coalesce(col(bounds["p25"]), med), F.coalesce(col(bounds["p75"]), med)
    flat = (lo == med) & (hi == med)
    a = F.when(lo >= med, F.greatest(F.lit(0.0), med - 0.5)).otherwise(lo)
    b = F.when(hi <= med, med + 0.5).otherwise(hi)
    v = triangular(uniform(keys, purpose, seed=seed), a, med, b)
    v = v * (1.0 + uniform(keys, purpose + ":jitter", -jitter, jitter, seed=seed))
    if "p95" in bounds:
        v = F.least(v, col(bounds["p95"]))
    return F.when(flat, med).otherwise(v)


def lognormal_parameters(p25, median, p75, shift: float = 1.0) -> tuple[Column, Column]:
    """(mu, sigma) so that the quartiles of the shifted logs match."""
    sigma = (F.log(col(p75) + shift) - F.log(col(p25) + shift)) / (2 * 0.6745)
    return F.log(col(median) + shift), sigma


def lognormal(keys, purpose: str, p25, median, p75, cap=None, floor=None, shift: float = 1.0, seed: int = SEED) -> Column:
    mu, sigma = lognormal_parameters(p25, median, p75, shift)
    v = F.exp(mu + sigma * normal(keys, purpose, seed=seed))
    if cap is not None:
        v = F.least(v, cap)
    return F.greatest(v, F.lit(floor)) if floor is not None else v


def count_from_quartiles(keys, purpose: str, p25, median, p75, cap_of=None, margin: float = 0.15, seed: int = SEED) -> Column:
    """Whole lognormal count, at least 1, at most `(1 + margin)` times p75 (or another quantile)."""
    cap = F.floor(col(cap_of if cap_of is not None else p75) * (1.0 + margin))
    v = F.floor(lognormal(keys, purpose, p25, median, p75, seed=seed))
    return F.greatest(F.lit(1), F.least(v, cap)).cast("int")


def beta_parameters(p10, p25, median, p75, p90) -> dict[str, Column]:
    """Shape and range of the Beta that the five quantiles suggest."""
    low, top = col(p10), col(p90) * 1.10
    width = F.greatest(top - low, F.lit(1.0))
    mid = F.least(F.greatest((col(median) - low) / width, F.lit(0.01)), F.lit(0.99))
    iqr = F.greatest((col(p75) - col(p25)) / width, F.lit(0.05))
    conc = F.least(0.5 / (iqr * iqr), F.lit(50.0))
    return {
        "alpha": F.greatest(mid * conc, F.lit(0.5)),
        "beta": F.greatest((1.0 - mid) * conc, F.lit(0.5)),
        "low": low,
        "top": top,
        "width": width,
    }


@F.pandas_udf(DoubleType())
def beta_quantile(u: pd.Series, alpha: pd.Series, beta: pd.Series) -> pd.Series:
    """Inverse Beta CDF for shapes of at least one half.

    With x = sin(t)^2 the density is bounded on [0, pi/2], so one trapezoid grid per
    distinct shape in the batch is enough.
    """
    out = np.full(len(u), np.nan)
    shapes = pd.DataFrame({"a": alpha, "b": beta, "u": u})
    t = np.linspace(0.0, np.pi / 2, 4097)
    s, c = np.sin(t), np.cos(t)
    for (a, b), rows in shapes.dropna().groupby(["a", "b"]).indices.items():
        dens = s ** (2 * a - 1) * c ** (2 * b - 1)
        cdf = np.concatenate([[0.0], np.cumsum((dens[1:] + dens[:-1]) / 2)])
        angle = np.interp(shapes["u"].to_numpy()[rows], cdf / cdf[-1], t)
        out[rows] = np.sin(angle) ** 2
    return pd.Series(out)


def beta(keys, purpose: str, p10, p25, median, p75, p90, seed: int = SEED) -> Column:
    """Beta draw on [p10, 1.1 * p90], clipped to that range."""
    p = beta_parameters(p10, p25, median, p75, p90)
    x = beta_quantile(uniform(keys, purpose, seed=seed), p["alpha"], p["beta"])
    return F.least(F.greatest(p["low"] + x * p["width"], p["low"]), p["top"])


def poisson(u: Column, mean, cap) -> Column:
    """Poisson draw by walking the distribution function up to `u`, capped at `cap`; 0 for a null mean or one of 0 or less.

    The walk starts 12 standard deviations (and 40) below the mean, where there is no mass a double can tell (from Stirling's
    series, if that leaves out small numbers), and ends where Bernstein's inequality leaves less than 1 - u above.
    """
    lam = col(mean).cast("double")
    reach = 12.0 * F.sqrt(F.greatest(lam, F.lit(0.0))) + 40.0
    left = -F.log(F.greatest(1.0 - u, F.lit(1e-17)))
    above = left / 3 + F.sqrt(left * left / 9 + 2.0 * left * F.greatest(lam, F.lit(0.0)))
    low = F.floor(lam - reach)
    low = F.when(low < 10, F.lit(0)).otherwise(low).cast("int")
    capped, high = F.floor(col(cap)).cast("int"), F.ceil(lam + above).cast("int") + 2
    high = F.greatest(low + 1, F.when(capped.isNull(), high).otherwise(F.least(high, capped)))
    k = F.greatest(low, F.lit(1)).cast("double")
    log_factorial = k * F.log(k) - k + 0.5 * F.log(2 * math.pi * k) + 1 / (12 * k) - 1 / (360 * k**3) + 1 / (1260 * k**5)
    first = F.when(low == 0, F.exp(-lam)).otherwise(F.exp(low * F.log(lam) - lam - log_factorial))
    start = F.struct(first.alias("pmf"), first.alias("cdf"), low.alias("n"), (u < first).alias("done"))

    def step(acc: Column, k: Column) -> Column:
        pmf = acc["pmf"] * lam / k.cast("double")
        cdf = acc["cdf"] + pmf
        return F.struct(
            pmf.alias("pmf"),
            cdf.alias("cdf"),
            F.when(acc["done"], acc["n"]).otherwise(k).alias("n"),
            (acc["done"] | (u < cdf)).alias("done"),
        )

    n = F.aggregate(F.sequence(low + 1, high), start, step)["n"]
    n = F.when(lam > 0, n).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.coalesce(F.least(n, F.floor(col(cap)).cast("int")), n)).cast("int")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once; a column that is used several times, or inside a fold, is computed as often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def categorical(u: Column, items, weights) -> Column:
    """Item whose cumulative weight first exceeds `u` times the total. Arrays, or Python literals."""
    if isinstance(items, Mapping):
        items, weights = list(items), list(items.values())
    it = items if isinstance(items, Column) else F.array(*[F.lit(i) for i in items])
    if isinstance(weights, Column):
        total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
        start = F.struct(F.lit(0.0).alias("cum"), F.lit(0).alias("i"))

        def seen(upto: Column) -> Column:
            return F.aggregate(
                weights,
                start,
                lambda a, w: F.struct(
                    (a["cum"] + w).alias("cum"), (a["i"] + F.when(a["cum"] + w <= upto, 1).otherwise(0)).alias("i")
                ),
            )["i"]

        return F.element_at(it, F.least(let(u * total, seen) + 1, F.size(it)))
    cums = list(itertools.accumulate(map(float, weights), initial=0.0))[1:]
    x = u * F.lit(cums[-1] if cums else 0.0)
    passed = [F.when(F.lit(c) <= x, 1).otherwise(0) for c in cums]
    return F.element_at(it, F.least(functools.reduce(operator.add, passed, F.lit(1)), F.size(it)))


def menu(item, weight) -> Column:
    """Aggregate of a vocabulary, for many rows that draw from it: the items in order and their weights, added up."""
    rows = F.sort_array(F.collect_list(F.struct(col(item).alias("i"), col(weight).cast("double").alias("w"))))
    return F.struct(F.transform(rows, lambda x: x["i"]).alias("items"), cumulated(F.transform(rows, lambda x: x["w"])).alias("cums"))


def from_menu(u: Column, menu) -> Column:
    """`categorical` of the menu's items and weights."""
    items, cums = col(menu)["items"], col(menu)["cums"]
    passed = let(u * F.get(cums, F.size(cums) - 1), lambda x: F.size(F.filter(cums, lambda c: c <= x)))
    return F.element_at(items, F.least(passed + 1, F.size(items)))


def cumulated(weights: Column) -> Column:
    """Cumulative weights, first to last."""
    return F.aggregate(weights, F.array().cast("array<double>"), lambda a, w: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.when(F.size(a) == 0, 0.0)) + w)))


def smoothed_pmf(u: Column, pmf: Column, low, high, eps: float = 1e-3) -> Column:
    """Whole number in [low, high] with weight `pmf[k] + eps`."""
    ks = F.sequence(col(low).cast("int"), col(high).cast("int"))
    wt = F.transform(ks, lambda k: F.coalesce(F.try_element_at(pmf, k), F.lit(0.0)) + eps)
    return categorical(u, ks, wt)


def sampling_key(keys, purpose: str, weight, seed: int = SEED) -> Column:
    """Ascending order of `-ln(u) / w` is a weighted sample without replacement."""
    return -F.log(uniform(keys, purpose, seed=seed)) / col(weight)


def soft_bound(x, p95, p99, keys, purpose: str, margin: float = 0.20, jitter: float = 0.06, seed: int = SEED) -> Column:
    """Above p95 fall back near p95, otherwise jitter; never above p99."""
    v, soft = col(x), col(p95)
    out = F.when(v > soft, soft * (1.0 + uniform(keys, purpose + ":over", 0.0, margin, seed=seed))).otherwise(
        v * (1.0 + uniform(keys, purpose + ":jitter", -jitter, jitter, seed=seed))
    )
    return F.least(out, col(p99))


def soft_range(x, low, high, keys, purpose: str, jitter: float = 0.06, margin: float = 0.15, seed: int = SEED) -> Column:
    """Beyond a margin outside [low, high] restart just inside the bound; clip to the bounds at the end."""
    v, lo, hi = col(x), col(low), col(high)
    u = uniform(keys, purpose + ":in", 0.0, margin, seed=seed)
    out = (
        F.when(v < lo * (1 - margin), lo * (1.0 + u))
        .when(v > hi * (1 + margin), hi * (1.0 - u))
        .otherwise(v * (1.0 + uniform(keys, purpose + ":jitter", -jitter, jitter, seed=seed)))
    )
    return F.least(F.greatest(out, lo), hi)


def tail_clamp(x, p10, p90, p99) -> Column:
    """Square-root compression between p90 and p99; floor p10, cap p99."""
    v, lo, hi, top = col(x), col(p10), col(p90), col(p99)
    over = (v - hi) / (top - hi + 1e-9)
    return F.when(v > top, top).when(v > hi, hi + (top - hi) * F.sqrt(over)).otherwise(F.greatest(v, lo))


def probit(p: Column) -> Column:
    """Inverse normal CDF, Acklam's published rational approximation (relative error about 1e-9)."""
    # fixed values: the published coefficients
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
         1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
         6.680131188771972e01, -1.328068155288572e01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
         -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)

    def poly(cs, x):
        out = F.lit(cs[0])
        for k in cs[1:]:
            out = out * x + k
        return out

    tail = 0.02425
    ql, qh, q = F.sqrt(-2.0 * F.log(p)), F.sqrt(-2.0 * F.log(1.0 - p)), p - 0.5
    r = q * q
    return (
        F.when(p < tail, poly(c, ql) / poly(d, ql))
        .when(p > 1 - tail, -poly(c, qh) / poly(d, qh))
        .otherwise(poly(a, r) * q / poly(b, r))
    )


def normal_cdf(z: Column) -> Column:
    """Logistic-type approximation (absolute error below 2e-4): enough to place a draw on a quantile grid."""
    return 1.0 / (1.0 + F.exp(-(1.5976 * z + 0.070565992 * z * z * z)))
