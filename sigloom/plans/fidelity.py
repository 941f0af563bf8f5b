"""How close generated rows are to real ones: distances, effect sizes, rank statistics, utility."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions import draws
from sigloom.operators.levels import unpivot_fields
from sigloom.operators.ordered import one_key, ordered
from sigloom.operators.quantiles import exact_quantiles
from sigloom.operators.setops import union_all
from sigloom.operators.windows import changes
from sigloom.plans import boosting
from sigloom.plans.boosting import ALL, REAL, SYNTHETIC, Boosted, Candidate, Spec
from sigloom.session import cut_lineage


# labels and features


def overrun_label(entities: DataFrame, versions: DataFrame, target: str, order: Sequence[str], entity: str = "entity_id", min_shift: int = 14, limit: int = 60) -> DataFrame:
    """Days of genuine target shifts per entity; an overrun is more than `limit` days in total."""
    ch = changes(versions.select(entity, *order, target), [entity], list(order), target)
    ch = ch.withColumn("__d", F.datediff(target, f"prev_{target}"))
    per = ch.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_changes"), F.sum(F.when(F.col("__d") > min_shift, F.col("__d")).otherwise(0)).alias("delay_days")
    )
    out = entities.join(per, entity, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_changes", "delay_days")})
    return out.withColumn("is_overrun", (F.col("delay_days") > limit).cast("int"))


def clean_category(x: str, default: str = "unknown") -> Column:
    return F.lower(F.trim(F.coalesce(F.col(x), F.lit(default))))


def encode(frames: Sequence[DataFrame], category: str, out: str) -> list[DataFrame]:
    """Alphabetical code of a category over all frames: the row number in the sorted vocabulary, joined back."""
    vocab = union_all([f.select(clean_category(category).alias("__c")) for f in frames]).distinct().withColumn("__all", one_key("__c"))
    codes = ordered(vocab, ["__all"], ["__c"], row_number="__i").select("__c", (F.col("__i") - 1).alias(out))
    return [f.withColumn("__c", clean_category(category)).join(codes, "__c", "left").select(*f.columns, out) for f in frames]


# distances


def _both(real: DataFrame, synth: DataFrame, features: Sequence[str]) -> DataFrame:
    a = unpivot_fields(real, [], features).filter("value IS NOT NULL").withColumn("is_real", F.lit(1))
    b = unpivot_fields(synth, [], features).filter("value IS NOT NULL").withColumn("is_real", F.lit(0))
    return a.unionByName(b)


def ks(real: DataFrame, synth: DataFrame, features: Sequence[str], **kw) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value per feature.

    Rows collapse to counts per distinct value; the running counts are sliced, so no feature has
    to be sorted by one task.
    """
    n = F.col("is_real")
    counts = _both(real, synth, features).groupBy("field", "value").agg(
        F.sum(n).alias("r"), F.sum(1 - n).alias("s"), F.count(F.lit(1)).alias("k")
    )
    run = ordered(counts, ["field"], ["value"], running_sum={"cr": "r", "cs": "s"}, total={"nr": "r", "ns": "s"}, **kw)
    out = run.groupBy("field").agg(
        F.max(F.abs(F.col("cr") / F.col("nr") - F.col("cs") / F.col("ns"))).alias("ks"), F.max("nr").alias("n_real"), F.max("ns").alias("n_synth")
    )
    lam = F.sqrt(F.col("n_real") * F.col("n_synth") / (F.col("n_real") + F.col("n_synth"))) * F.col("ks")
    series = sum(((-1) ** (j - 1)) * F.exp(-2.0 * j * j * lam * lam) for j in range(1, 21)) * 2.0
    p = F.when(lam < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return out.withColumn("p_value", p)


def effect_band(x: Column, small: float, medium: float) -> Column:
    return F.when(F.abs(x) < small, "small").when(F.abs(x) < medium, "medium").otherwise("large")


def cohens_d(real: DataFrame, synth: DataFrame, features: Sequence[str], digits: int = 6) -> DataFrame:
    n = F.col("is_real") == 1
    v = F.col("value")
    st = _both(real, synth, features).groupBy("field").agg(
        F.avg(F.when(n, v)).alias("mr"), F.avg(F.when(~n, v)).alias("ms"),
        F.stddev_samp(F.when(n, v)).alias("sr"), F.stddev_samp(F.when(~n, v)).alias("ss"),
    )
    d = (F.col("mr") - F.col("ms")) / (F.sqrt((F.col("sr") * F.col("sr") + F.col("ss") * F.col("ss")) / 2) + 1e-9)
    return st.select("field", F.round(d, digits).alias("cohens_d"), effect_band(d, 0.2, 0.5).alias("effect"))


def chi_square(real: DataFrame, synth: DataFrame, category: str, digits: int = 6) -> DataFrame:
    """Goodness of fit of the synthetic shares on the real categories, with Cramer's V.

    Synthetic counts are scaled to the real total, zeros become one half, then scaled again.
    """
    r = real.groupBy(category).agg(F.count(F.lit(1)).alias("r"))
    s = synth.groupBy(category).agg(F.count(F.lit(1)).alias("s"))
    both = r.join(s, category, "left").withColumn("s", F.coalesce(F.col("s"), F.lit(0)).cast("double"))
    # one row per category of a vocabulary from here on
    tot = both.agg(F.struct(F.sum("r").alias("r"), F.sum("s").alias("s"))).scalar()
    scaled = both.withColumn("e", F.col("s") / tot["s"] * tot["r"])
    scaled = scaled.withColumn("e", F.when(F.col("e") == 0, 0.5).otherwise(F.col("e")))
    total = scaled.agg(F.sum("e")).scalar()
    fit = scaled.withColumn("e", F.col("e") * (tot["r"] / total))
    out = fit.agg(
        F.sum((F.col("r") - F.col("e")) * (F.col("r") - F.col("e")) / F.col("e")).alias("chi2"), F.sum("r").alias("n"), F.count(F.lit(1)).alias("k")
    )
    v = F.when(F.col("k") > 1, F.sqrt(F.col("chi2") / (F.col("n") * (F.col("k") - 1)))).otherwise(0.0)
    return out.select(
        F.lit(category).alias("field"), F.round("chi2", digits).alias("chi2"), "n", "k", F.round(v, digits).alias("cramers_v"),
        effect_band(v, 0.1, 0.3).alias("effect"),
    )


# rank statistics


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score."""
    w = F.col(weight) if weight else F.lit(1)
    pos = F.col(label) == 1
    return df.filter(F.col(score).isNotNull()).groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(pos, w).otherwise(0)).alias("pos"), F.sum(F.when(~pos, w).otherwise(0)).alias("neg"), F.count(F.lit(1)).alias("k")
    )


def auc_from_counts(counts: DataFrame, keys: Sequence[str], min_rows: int = 0, min_pos: int = 1, digits: int | None = None, **kw) -> DataFrame:
    """Mann-Whitney AUC; equal scores count one half. One class only gives no row."""
    names = list(keys)
    if not names:
        counts, names = counts.withColumn("__all", one_key("score")), ["__all"]
    run = ordered(counts, names, ["score"], running_sum={"cn": "neg"}, **kw)
    out = run.groupBy(*names).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("k").alias("n"),
        F.sum(F.col("pos") * (F.col("cn") - F.col("neg") / 2)).alias("__u"),
    )
    out = out.filter((F.col("n_pos") >= min_pos) & (F.col("n_neg") > 0) & (F.col("n") >= min_rows))
    auc = F.col("__u") / (F.col("n_pos") * F.col("n_neg"))
    return out.select(*keys, "n", "n_pos", (F.round(auc, digits) if digits is not None else auc).alias("auc"))


def auc(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), **kw) -> DataFrame:
    return auc_from_counts(score_counts(df, score, label, keys), keys, **kw)


def bootstrap_auc(df: DataFrame, score: str, label: str, replicates: int = 1000, seed: int = draws.SEED) -> DataFrame:
    """Percentile interval of the AUC over Poisson bootstrap replicates.

    Rows with one score share a sum of Poisson(1) weights, which is Poisson(count), drawn from the score. Scores are dealt in ranges; a task
    walks its range once for all replicates and hands on (positives, negatives, wins over negatives below) for each. These add up along the
    ranges: a range's positives also win over all negatives of the ranges below it.
    """
    counts = score_counts(df, score, label).select("score", F.col("pos").cast("double").alias("pos"), F.col("neg").cast("double").alias("neg"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def walk(batches):
        pos, neg, wins = np.zeros(replicates), np.zeros(replicates), np.zeros(replicates)
        for batch in batches:
            for s, p, n in zip(*(batch.column(c).to_numpy() for c in ("score", "pos", "neg")), strict=True):
                rng = np.random.default_rng([seed, int(np.float64(s).view(np.uint64))])
                drawn_pos, drawn_neg = rng.poisson(p, replicates), rng.poisson(n, replicates)
                wins += drawn_pos * (neg + drawn_neg / 2)
                pos += drawn_pos
                neg += drawn_neg
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(replicates, part)), pa.array(np.arange(replicates)), pa.array(pos), pa.array(neg), pa.array(wins)], names=["part", "rep", "pos", "neg", "wins"])

    ranged = counts.repartitionByRange(parts, "score").sortWithinPartitions("score")
    states = ranged.mapInArrow(walk, "part long, rep long, pos double, neg double, wins double")
    below = F.coalesce(F.sum("neg").over(W.partitionBy("rep").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    total = states.withColumn("wins", F.col("wins") + F.col("pos") * below).groupBy("rep").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "wins")])
    aucs = total.filter("pos > 0 AND neg > 0").select((F.col("wins") / (F.col("pos") * F.col("neg"))).alias("auc"))
    ci = exact_quantiles(aucs, [], "auc", {"ci_low": 0.025, "ci_high": 0.975}, count="n_replicates")
    return ci.withColumn("auc", auc(df, score, label).agg(F.max("auc")).scalar())


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """n / (classes * rows of the class)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    sizes = per.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = per.select(label, (sizes["n"] / (sizes["k"] * F.col("__n"))).alias(out))
    return df.join(weights, label)


# utility of the generated rows


def folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = draws.SEED) -> DataFrame:
    """Fold number by a draw from the key; large classes fall evenly into the folds."""
    return df.withColumn("fold", F.floor(draws.uniform([key], "fold", seed=seed) * k).cast("int"))


class Search:
    """A searched classifier for each purpose, all grown in one run.

    For every source, outer fold (and none) and candidate there is a model for each inner fold and one without: the inner ones choose the
    candidate by their mean AUC on the rows they left out, the other one is the choice fitted on all rows of the training part.
    """

    def __init__(self, real: DataFrame, synth: DataFrame | None, key: str, features: Sequence[str], label: str, candidates: Sequence[Candidate], k: int = 5, inner: int = 3, outer: bool = True, whole: bool = False, bins: int = boosting.BINS):
        both = real.select(*features) if synth is None else real.select(*features).unionByName(synth.select(*features))
        self.key, self.features, self.label, self.k = key, list(features), label, k
        self.cuts = boosting.borders(both, features, bins)
        parts = [boosting.binned(real, key, features, label, self.cuts, k, inner, REAL)]
        if synth is not None:
            parts.append(boosting.binned(synth, key, features, label, self.cuts, k, inner, SYNTHETIC))
        groups = [(REAL, f) for f in (range(k) if outer else ())] + [(REAL, ALL)] * whole + [(SYNTHETIC, ALL)] * (synth is not None)
        specs = [Spec(s, f, i, c) for s, f in groups for c in range(len(candidates)) for i in (*range(inner), ALL)]
        self.table = boosting.stored(union_all(parts))
        self.models = Boosted(self.table, candidates, specs, len(features), bins).fit()
        self.chosen = self._choose()

    def _choose(self) -> dict[tuple[int, int], int]:
        """(source, outer fold) -> the model of the candidate with the best mean inner AUC, the first of equal ones."""
        specs = self.models.specs
        inner = [m for m, s in enumerate(specs) if s.inner != ALL]
        aucs = {r["model"]: r["auc"] for r in self._held_out_auc(inner, "model", digits=9).collect()}
        found: dict[tuple[int, int], dict[int, list[float]]] = {}
        for m in inner:
            s = specs[m]
            found.setdefault((s.source, s.fold), {}).setdefault(s.candidate, []).append(aucs.get(m, 0.5))
        best = {g: max(sorted(c), key=lambda x: round(sum(c[x]) / len(c[x]), 9)) for g, c in found.items()}
        return {g: specs.index(Spec(*g, ALL, c)) for g, c in best.items()}

    def _held_out_auc(self, models: Sequence[int], key: str, **kw) -> DataFrame:
        return auc_from_counts(score_counts(self.models.held_out(models, packed=True), "score", "y", [key], "n"), [key], **kw)

    def cross_validated(self) -> DataFrame:
        """Mean, deviation and normal interval of the outer folds' AUC."""
        per = self._held_out_auc([m for (source, fold), m in self.chosen.items() if source == REAL and fold != ALL], "fold")
        half = 1.96 * F.stddev_pop("auc") / F.sqrt(F.count(F.lit(1)))
        return per.agg(
            F.count(F.lit(1)).alias("n_folds"), F.avg("auc").alias("auc"), F.stddev_pop("auc").alias("auc_std"),
            (F.avg("auc") - half).alias("ci_low"), (F.avg("auc") + half).alias("ci_high"),
        )

    def scored_by_synthetic(self) -> DataFrame:
        """All real rows (key, y, score), scored by the model that saw synthetic rows only."""
        real = self.table.filter(F.col("source") == REAL)
        return self.models.score(real, self.chosen[SYNTHETIC, ALL], f"key {dict(real.dtypes)['key']}, y int")

    def permuted(self) -> DataFrame:
        """Real rows, a copy for each feature (and one, -1, as they are), whose bin of that feature is another row's.

        Each feature has two orders of the rows, by two draws; the rows with one number in both give and get the bin.
        """
        real = self.table.filter(F.col("source") == REAL).select("key", "y", "bins")
        copies = real.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(len(self.features) - 1))))
        take = draws.uniform(["key", "feature"], "permute:take")
        give = draws.uniform(["key", "feature"], "permute:give")
        got = ordered(copies.withColumn("__t", take), ["feature"], ["__t", "key"], row_number="__i")
        gave = ordered(copies.select("feature", "key", F.get("bins", F.col("feature")).alias("__b"), give.alias("__g")), ["feature"], ["__g", "key"], row_number="__i")
        both = got.join(gave.select("feature", "__i", "__b"), ["feature", "__i"])
        other = F.transform("bins", lambda b, j: F.when(j == F.col("feature"), F.col("__b")).otherwise(b))
        return real.select(F.lit(-1).alias("feature"), "y", "bins").unionByName(both.select("feature", "y", other.alias("bins")))

    def importances(self) -> DataFrame:
        """Rows (feature, real_importance, synth_importance): what permuting a feature of the real rows takes from both models' AUC."""
        rows = boosting.stored(self.permuted())
        names = F.array(*map(F.lit, self.features))
        out = None
        for source, name in ((REAL, "real_importance"), (SYNTHETIC, "synth_importance")):
            aucs = auc(self.models.score(rows, self.chosen[source, ALL], "feature int, y int"), "score", "y", ["feature"], digits=9)
            base = aucs.filter("feature < 0").agg(F.max("auc")).scalar()
            lost = aucs.filter("feature >= 0").select(F.get(names, F.col("feature")).alias("feature"), F.round(base - F.col("auc"), 9).alias(name))
            out = lost if out is None else out.join(lost, "feature")
        return out


#: how many candidates the searches draw
SEARCHED, SEARCHED_WHOLE = 30, 50


def trtr(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, inner: int = 3, candidates: Sequence[Candidate] | None = None) -> DataFrame:
    """Nested cross-validation on real rows: AUC of the outer folds, candidates chosen in inner ones."""
    return Search(df, None, key, features, label, candidates or boosting.drawn_candidates(SEARCHED), k, inner).cross_validated()


def tstr(real: DataFrame, synth: DataFrame, key: str, features: Sequence[str], label: str, inner: int = 3, candidates: Sequence[Candidate] | None = None) -> DataFrame:
    """Real rows (key, y, score) scored by a searched model that saw synthetic rows only."""
    return Search(real, synth, key, features, label, candidates or boosting.drawn_candidates(SEARCHED_WHOLE), inner=inner, outer=False).scored_by_synthetic()


def tstr_utility(real: DataFrame, synth: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, inner: int = 3, candidates: Sequence[Candidate] | None = None) -> DataFrame:
    """Both in one run: TSTR AUC, TRTR AUC, their ratio."""
    found = Search(real, synth, key, features, label, candidates or boosting.drawn_candidates(SEARCHED), k, inner)
    return utility(found.cross_validated(), auc(found.scored_by_synthetic(), "score", "y"))


def utility(real_auc: DataFrame, synth_auc: DataFrame, target: float = 0.75) -> DataFrame:
    """TSTR over TRTR."""
    a, b = synth_auc.agg(F.max("auc")).scalar(), real_auc.agg(F.max("auc")).scalar()
    spark = real_auc.sparkSession
    out = spark.range(1).select(a.alias("tstr_auc"), b.alias("trtr_auc"))
    ratio = F.col("tstr_auc") / F.col("trtr_auc")
    return out.withColumns({"utility_ratio": ratio, "passed": ratio >= target})


def importance_preservation(real: DataFrame, synth: DataFrame, key: str, features: Sequence[str], label: str, target: float = 0.70, inner: int = 3, candidates: Sequence[Candidate] | None = None) -> DataFrame:
    """Permutation importances of two searched models on the real rows, their ranks, and Spearman's correlation of the ranks."""
    found = Search(real, synth, key, features, label, candidates or boosting.drawn_candidates(SEARCHED_WHOLE), inner=inner, outer=False, whole=True)
    return spearman(found.importances(), "feature", "real_importance", "synth_importance", target)


def spearman(df: DataFrame, name: str, a: str, b: str, target: float = 0.70) -> DataFrame:
    """Average ranks of two short vectors and their correlation on every row."""
    def rank(x: str) -> Column:
        w = W.orderBy(F.desc(x))  # one row per feature of a model
        return F.rank().over(w) + (F.count(F.lit(1)).over(W.partitionBy(x)) - 1) / 2

    ranked = df.withColumns({f"{a}_rank": rank(a), f"{b}_rank": rank(b)})
    rho = ranked.agg(F.corr(f"{a}_rank", f"{b}_rank")).scalar()
    return ranked.withColumns({"spearman": rho, "passed": rho >= target})
