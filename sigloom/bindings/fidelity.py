"""Fidelity statistics: orders before a cut-off date as the real rows, later ones as the synthetic."""

import numpy as np
from pyspark.sql import functions as F

from sigloom.bindings.aggregating import rounded
from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.functions import draws
from sigloom.operators.ordered import written
from sigloom.plans import boosting
from sigloom.plans import fidelity as fi

CUT = "1998-04-01"
SPLIT = f"""
real AS (SELECT * FROM entity WHERE dt_start < DATE '{CUT}'), syn AS (SELECT * FROM entity WHERE dt_start >= DATE '{CUT}')"""
FEATURES = ("amt_contract", "gross_area")


def split(v):
    cut = F.lit(CUT).cast("date")
    return v.entity.filter(F.col("dt_start") < cut), v.entity.filter(F.col("dt_start") >= cut)


OVERRUN = """
ch AS (SELECT entity_id, date_diff('day', p, target_date) AS d FROM (SELECT *, lag(target_date) OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS p FROM version) WHERE p IS NOT NULL AND p <> target_date),
ov AS (SELECT p.entity_id, coalesce(c.n, 0) AS n_changes, coalesce(c.dd, 0) AS delay_days FROM project p LEFT JOIN (SELECT entity_id, count(*) AS n, sum(CASE WHEN d > 14 THEN d ELSE 0 END) AS dd FROM ch GROUP BY 1) c USING (entity_id))"""


@query("F1_overrun_label", with_("project", "version", extra=OVERRUN, body="SELECT entity_id, n_changes, CAST(delay_days AS BIGINT) AS delay_days, CASE WHEN delay_days > 2500 THEN 1 ELSE 0 END AS is_overrun FROM ov"))
def _(v):
    return fi.overrun_label(v.project.select("entity_id"), v.version, "target_date", ["effective_from", "code"], limit=2500)


@query("F2_category_encoding", with_("entity", extra=SPLIT, body="""
SELECT entity_id, CAST(code AS INTEGER) AS asset_code FROM real JOIN (SELECT c, row_number() OVER (ORDER BY c) - 1 AS code FROM (SELECT DISTINCT lower(trim(asset)) AS c FROM entity)) ON c = lower(trim(asset))"""))
def _(v):
    real, syn = split(v)
    return fi.encode([real, syn], "asset", "asset_code")[0].select("entity_id", "asset_code")


KS = "".join(
    f"""{',' if i else ''}
k{i} AS (SELECT '{f}' AS field, max(abs(cr / CAST(nr AS DOUBLE) - cs / CAST(ns AS DOUBLE))) AS ks, max(nr) AS n_real, max(ns) AS n_synth FROM (SELECT sum(r) OVER (ORDER BY v) AS cr, sum(s) OVER (ORDER BY v) AS cs, sum(r) OVER () AS nr, sum(s) OVER () AS ns
 FROM (SELECT v, sum(r) AS r, sum(1 - r) AS s FROM (SELECT {f} AS v, 1 AS r FROM real WHERE {f} IS NOT NULL UNION ALL SELECT {f}, 0 FROM syn WHERE {f} IS NOT NULL) GROUP BY 1)))"""
    for i, f in enumerate(FEATURES)
)


@query("F3_ks_statistic", with_("entity", extra=SPLIT + "," + KS, body="SELECT field, round(ks, 8) AS ks, CAST(n_real AS BIGINT) AS n_real, CAST(n_synth AS BIGINT) AS n_synth FROM k0 UNION ALL SELECT field, round(ks, 8), CAST(n_real AS BIGINT), CAST(n_synth AS BIGINT) FROM k1"))
def _(v):
    return fi.ks(*split(v), FEATURES).select("field", F.round("ks", 8).alias("ks"), "n_real", "n_synth")


def d_sql(f):
    d = f"((SELECT avg({f}) FROM real) - (SELECT avg({f}) FROM syn)) / (sqrt(((SELECT var_samp({f}) FROM real) + (SELECT var_samp({f}) FROM syn)) / 2) + 1e-9)"
    return f"SELECT '{f}' AS field, round(d, 6) AS cohens_d, CASE WHEN abs(d) < 0.2 THEN 'small' WHEN abs(d) < 0.5 THEN 'medium' ELSE 'large' END AS effect FROM (SELECT {d} AS d)"


@query("F4_cohens_d", with_("entity", extra=SPLIT, body=" UNION ALL ".join(d_sql(f) for f in FEATURES)))
def _(v):
    return fi.cohens_d(*split(v), FEATURES)


CHI = SPLIT + """,
rs AS (SELECT r.region, r.n AS r, coalesce(s.n, 0) AS s FROM (SELECT region, count(*) AS n FROM real GROUP BY 1) r LEFT JOIN (SELECT region, count(*) AS n FROM syn WHERE region <> 'NATION_3' GROUP BY 1) s USING (region)),
e1 AS (SELECT *, CASE WHEN s = 0 THEN CAST(0.5 AS DOUBLE) ELSE s / CAST((SELECT sum(s) FROM rs) AS DOUBLE) * (SELECT sum(r) FROM rs) END AS e FROM rs),
e2 AS (SELECT r, e * ((SELECT sum(r) FROM rs) / (SELECT sum(e) FROM e1)) AS e FROM e1),
cs AS (SELECT sum((r - e) * (r - e) / e) AS chi2, CAST(sum(r) AS BIGINT) AS n, count(*) AS k FROM e2)"""


def chi(v):
    real, syn = split(v)
    return fi.chi_square(real, syn.filter("region <> 'NATION_3'"), "region")


@query("F5_chi_square", with_("entity", extra=CHI, body="SELECT 'region' AS field, round(chi2, 6) AS chi2, n, k FROM cs"))
def _(v):
    return chi(v).select("field", "chi2", "n", "k")


@query("F6_cramers_v", with_("entity", extra=CHI, body="SELECT 'region' AS field, round(v, 6) AS cramers_v, CASE WHEN v < 0.1 THEN 'small' WHEN v < 0.3 THEN 'medium' ELSE 'large' END AS effect FROM (SELECT sqrt(chi2 / (n * (k - 1))) AS v FROM cs)"))
def _(v):
    return chi(v).select("field", "cramers_v", "effect")


def labelled(v):
    """Customers with an overrun label and three numeric features."""
    p = v.project.select("entity_id", "amt_contract", F.datediff("dt_end", "dt_start").alias("duration"), "n_orders", "sbu")
    return fi.overrun_label(p.filter("duration IS NOT NULL"), v.version, "target_date", ["effective_from", "code"], limit=2500)


ML_FEATURES = ("amt_contract", "duration", "n_orders")


def halves(v):
    df = written(labelled(v))  # bin borders and bins read both halves
    return df.filter("entity_id % 2 = 0"), df.filter("entity_id % 2 = 1")


#: a search in the reference's shape, five outer and three inner folds, over shorter models
CANDIDATES = boosting.drawn_candidates(6, rounds=(6, 16), depth=(2, 3), rate=(0.05, 0.3))


@query("F7_trtr_cross_validation")
def _(v):
    return rounded(fi.trtr(halves(v)[0], "entity_id", ML_FEATURES, "is_overrun", candidates=CANDIDATES))


@query("F8_tstr_utility")
def _(v):
    """The library's whole search: 30 candidates of 100 to 499 rounds."""
    return rounded(fi.tstr_utility(*halves(v), "entity_id", ML_FEATURES, "is_overrun"))


LABELLED = OVERRUN + """,
la AS (SELECT entity_id, amt_contract::DOUBLE AS amt_contract, date_diff('day', dt_start, dt_end)::DOUBLE AS duration, n_orders::DOUBLE AS n_orders, CASE WHEN delay_days > 2500 THEN 1 ELSE 0 END AS y
 FROM project JOIN ov USING (entity_id) WHERE dt_end IS NOT NULL AND dt_start IS NOT NULL AND entity_id % 2 = 0),
lo AS (SELECT entity_id, y, CAST(floor(""" + draws.uniform_sql(["entity_id"], "fold") + """ * 5) AS INTEGER) AS fold, f.i, f.x FROM la, unnest([{'i': 0, 'x': amt_contract}, {'i': 1, 'x': duration}, {'i': 2, 'x': n_orders}]) AS t(f)
 WHERE amt_contract IS NOT NULL AND n_orders IS NOT NULL),
cu AS (SELECT f.i, list_transform(quantile_cont(f.x, [k / CAST(16 AS DOUBLE) FOR k IN range(1, 16)]), lambda q: round(q, 6)) AS q FROM la, unnest([{'i': 0, 'x': amt_contract}, {'i': 1, 'x': duration}, {'i': 2, 'x': n_orders}]) AS t(f) WHERE f.x IS NOT NULL GROUP BY 1),
bi AS (SELECT entity_id, y, fold, i, len(list_filter(q, lambda b: x > b)) AS bin FROM lo JOIN cu USING (i))"""


@query("F7_bin_counts", with_("project", "version", extra=LABELLED, body="SELECT fold, i AS feature, CAST(bin AS INTEGER) AS bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos FROM bi GROUP BY 1, 2, 3"))
def _(v):
    real = halves(v)[0]
    rows = boosting.binned(real, "entity_id", ML_FEATURES, "is_overrun", boosting.borders(real, ML_FEATURES), 5, 3, boosting.REAL)
    each = rows.select("fold", "y", F.posexplode("bins").alias("feature", "bin"))
    return each.groupBy("fold", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("n_pos"))


#: the first tree's first split of the five outer models without subsampling: gradients of a balanced prior are a half, their curvature a quarter of the weight
FIRST = LABELLED + """,
sz AS (SELECT f.fold AS model, y, count(*) AS n, sum(count(*)) OVER (PARTITION BY f.fold) AS total FROM (SELECT DISTINCT entity_id, fold, y FROM bi) b, range(5) AS f(fold) WHERE b.fold <> f.fold GROUP BY 1, 2),
hi AS (SELECT s.model, i, bin, sum(total / (2 * s.n)::DOUBLE * (b.y - 0.5)) AS g, sum(total / (2 * s.n)::DOUBLE * 0.25) AS h, count(*) AS n FROM bi b JOIN sz s ON b.y = s.y AND b.fold <> s.model GROUP BY 1, 2, 3),
cm AS (SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER p AS gt, sum(h) OVER p AS ht, sum(n) OVER p AS nt FROM hi WINDOW w AS (PARTITION BY model, i ORDER BY bin), p AS (PARTITION BY model, i)),
ga AS (SELECT *, round(gl * gl / hl + (gt - gl) * (gt - gl) / (ht - hl) - gt * gt / ht, 9) AS gain FROM cm WHERE nl >= 10 AND nt - nl >= 10)"""


@query("F7_first_split", with_("project", "version", extra=FIRST, body="""
SELECT CAST(model AS BIGINT) AS fold, CAST(i AS BIGINT) AS feature, CAST(bin AS BIGINT) AS bin, round(gain, 6) AS gain, CAST(nl AS BIGINT) AS n_left, CAST(nt - nl AS BIGINT) AS n_right
 FROM ga QUALIFY row_number() OVER (PARTITION BY model ORDER BY gain DESC, i, bin) = 1"""))
def _(v):
    real = halves(v)[0]
    rows = boosting.binned(real, "entity_id", ML_FEATURES, "is_overrun", boosting.borders(real, ML_FEATURES), 5, 3, boosting.REAL)
    models = boosting.Boosted(boosting.stored(rows), [boosting.Candidate(1, 1, 0.1, 1.0, 10)], [boosting.Spec(boosting.REAL, f, boosting.ALL, 0) for f in range(5)], len(ML_FEATURES))
    empty = boosting.Tree(np.full(3, -1), np.zeros(3, np.int64), np.zeros(3))
    found = models.splits(dict.fromkeys(range(5), empty), 0, 0)
    return found.select(F.col("model").alias("fold"), "feature", "bin", F.round("gain", 6).alias("gain"), "n_left", "n_right")


def auc_sql(keys, table, having=""):
    sel = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {sel}count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, round((sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 8) AS auc
 FROM (SELECT *, (rank() OVER ({part} ORDER BY s)) + (count(*) OVER ({part + ',' if part else 'PARTITION BY'} s) - 1) / CAST(2 AS DOUBLE) AS rk FROM {table}) {grp} {having}"""


SC = "sc AS (SELECT d.source AS grp, d.n_chars AS s, l.quality AS y FROM labels l JOIN documents d USING (doc_id))"


@query("F9_auc_by_group", "WITH " + SC + " " + auc_sql("grp", "sc", "HAVING count(*) >= 10 AND sum(y) >= 2 AND sum(y) < count(*)") + " UNION ALL SELECT 'all', * FROM (" + auc_sql("", "sc") + ")")
def _(v):
    d = v.table("documents", "doc_id", "source", "n_chars").join(v.table("labels", "doc_id", "quality"), "doc_id").withColumnRenamed("source", "grp")
    by = fi.auc(d, "n_chars", "quality", ["grp"], min_rows=10, min_pos=2, digits=8)
    return by.unionByName(fi.auc(d, "n_chars", "quality", digits=8).withColumn("grp", F.lit("all")))


@query("F10_bootstrap_interval")
def _(v):
    d = v.table("documents", "doc_id", "n_chars").join(v.table("labels", "doc_id", "quality"), "doc_id")
    return rounded(fi.bootstrap_auc(d, "n_chars", "quality"))


@query("F11_balanced_weights", "SELECT doc_id, quality, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * CAST(count(*) OVER (PARTITION BY quality) AS DOUBLE)), 8) AS weight FROM labels")
def _(v):
    return rounded(fi.balanced_weights(v.table("labels", "doc_id", "quality"), "quality"), 8)


@query("F12_importance_preservation")
def _(v):
    return rounded(fi.importance_preservation(*halves(v), "entity_id", ML_FEATURES, "is_overrun", candidates=CANDIDATES))
