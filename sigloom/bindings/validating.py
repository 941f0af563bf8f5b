"""Rule checks on the test tables seen as generated ones. Some rows break the rules on purpose."""

from collections.abc import Mapping

from pyspark.sql import functions as F

from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.functions import values
from sigloom.plans import checks

V = """
vp AS (SELECT p.* FROM project p JOIN customer c ON c.c_custkey = p.entity_id WHERE c.c_acctbal > -900),
vs AS (SELECT entity_id, CAST(code AS VARCHAR) || CASE WHEN code % 3 = 0 THEN '-BL' ELSE '-RB' END AS code, effective_from, effective_from + 90 AS effective_to, effective_from AS dt_ntp, target_date AS dt_tco, is_active FROM version),
vr AS (SELECT entity_id, effective_from AS occurred FROM vs WHERE code NOT LIKE '%-BL' AND code NOT LIKE '%7-RB'),
vt AS (SELECT o_custkey AS entity_id, CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 97 = 0 THEN '-XX' WHEN o_orderkey % 3 = 0 THEN '-BL' ELSE '-RB' END AS code, p_type AS sow, o_orderstatus = 'O' AS is_active, CAST(o_orderdate AS DATE) AS effective_from,
 count(*) AS n_total, count(*) FILTER (WHERE l_linestatus = 'F') AS n_completed, count(*) FILTER (WHERE l_linestatus <> 'F' AND l_returnflag = 'R') AS n_active,
 count(*) FILTER (WHERE l_linestatus <> 'F' AND l_returnflag <> 'R') - CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS n_not_started, CAST(min(l_shipdate) AS DATE) AS sow_start, CAST(max(l_shipdate) AS DATE) AS sow_finish
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY o_custkey, o_orderkey, o_orderstatus, o_orderdate, p_type),
ve AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS event_id, o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS created, CAST(l_shipdate AS DATE) AS due, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS resolved,
 CASE l_returnflag WHEN 'A' THEN 'closed' WHEN 'N' THEN 'open' ELSE 'overdue' END AS status, CASE WHEN l_linenumber = 1 THEN 'A SUBSTRUCTURE' WHEN l_linenumber < 4 THEN 'D SERVICES' WHEN l_linenumber < 7 THEN 'C INTERIORS' ELSE 'OTHER' END AS trade,
 CASE WHEN l_quantity < 10 THEN 'Pre-SOW' WHEN l_quantity < 40 THEN 'During' WHEN l_quantity < 49 THEN 'Post-SOW' ELSE 'Later' END AS timing, l_tax = 0.05 AS is_near, CASE WHEN l_linenumber = 2 THEN CAST(l_orderkey AS VARCHAR) || '-1' END AS parent_id
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
vb AS (SELECT o_custkey AS entity_id, p_brand AS division, p_size AS cost_code, CAST(l_shipdate AS DATE) AS dt_budget, sum(l_extendedprice) AS amt_jtd, sum(l_extendedprice * (1 + l_tax)) AS amt_ecac, sum(l_extendedprice) AS amt_projected,
 sum(l_extendedprice * l_tax) - sum(CASE WHEN l_discount > 0.09 THEN 5000 ELSE 0 END) AS amt_ftc, sum(l_extendedprice) AS amt_original, sum(l_extendedprice * l_tax) AS amt_in, -sum(l_extendedprice * l_discount) AS amt_out,
 sum(l_extendedprice * (1 + l_tax - l_discount)) + sum(CASE WHEN l_quantity < 3 THEN 900 ELSE 0 END) AS amt_revised FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4)"""


class Generated(Mapping):
    """The six tables by name, each planned when a check asks for it; `stored`: written once, where many checks read them."""

    NAMES = ("project", "schedule", "rebaseline", "task", "event", "budget")

    def __init__(self, v, stored: bool = False):
        self.v, self.stored, self.made = v, stored, {}

    def __getitem__(self, name):
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self.made:
            make = getattr(self, name)
            self.made[name] = self.v.stored(f"checked_{name}", make) if self.stored else make()
        return self.made[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self):
        return len(self.NAMES)

    def project(self):
        ok = self.v.table("customer", "c_custkey", "c_acctbal").filter("c_acctbal > -900").select(F.col("c_custkey").alias("entity_id"))
        return self.v.project.join(ok, "entity_id", "left_semi")

    def schedule(self):
        return self.v.version.select(
            "entity_id", code(F.col("code")).alias("code"), "effective_from", F.date_add("effective_from", 90).alias("effective_to"),
            F.col("effective_from").alias("dt_ntp"), F.col("target_date").alias("dt_tco"), "is_active",
        )

    def rebaseline(self):
        kept = ~F.col("code").endswith("-BL") & ~F.col("code").endswith("7-RB")
        return self["schedule"].filter(kept).select("entity_id", F.col("effective_from").alias("occurred"))

    def orders(self):
        return self.v.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")

    def task(self):
        lines = self.v.table("lineitem", "l_orderkey", "l_partkey", "l_linestatus", "l_returnflag", "l_shipdate").join(
            self.v.table("part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
        )
        work = lines.groupBy("l_orderkey", "p_type").agg(
            F.count(F.lit(1)).alias("n_total"), F.count_if(~_open()).alias("n_completed"), F.count_if(_open() & (F.col("l_returnflag") == "R")).alias("n_active"),
            F.count_if(_open() & (F.col("l_returnflag") != "R")).alias("k"), F.to_date(F.min("l_shipdate")).alias("sow_start"), F.to_date(F.max("l_shipdate")).alias("sow_finish"),
        )
        o = F.col("o_orderkey")
        return work.join(self.orders(), F.col("l_orderkey") == o).select(
            F.col("o_custkey").alias("entity_id"), code(o, o % 97 == 0).alias("code"), F.col("p_type").alias("sow"), (F.col("o_orderstatus") == "O").alias("is_active"),
            F.to_date("o_orderdate").alias("effective_from"), "n_total", "n_completed", "n_active",
            (F.col("k") - F.when(o % 50 == 0, 1).otherwise(0)).alias("n_not_started"), "sow_start", "sow_finish",
        )

    def event(self):
        n, q, key = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_orderkey").cast("string")
        lines = self.v.table("lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
        return lines.join(self.orders(), F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.concat_ws("-", key, n.cast("string")).alias("event_id"), F.col("o_custkey").alias("entity_id"),
            F.to_date("o_orderdate").alias("created"), F.to_date("l_shipdate").alias("due"), F.when(~_open(), F.to_date("l_shipdate")).alias("resolved"),
            F.when(F.col("l_returnflag") == "A", "closed").when(F.col("l_returnflag") == "N", "open").otherwise("overdue").alias("status"),
            F.when(n == 1, "A SUBSTRUCTURE").when(n < 4, "D SERVICES").when(n < 7, "C INTERIORS").otherwise("OTHER").alias("trade"),
            F.when(q < 10, "Pre-SOW").when(q < 40, "During").when(q < 49, "Post-SOW").otherwise("Later").alias("timing"),
            (F.col("l_tax") == 0.05).alias("is_near"), F.when(n == 2, F.concat(key, F.lit("-1"))).alias("parent_id"),
        )

    def budget(self):
        x, tax, disc = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
        return (
            self.v.table("lineitem", "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_tax", "l_discount", "l_shipdate")
            .join(self.v.table("part", "p_partkey", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.orders().select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("entity_id"), F.col("p_brand").alias("division"), F.col("p_size").alias("cost_code"), F.to_date("l_shipdate").alias("dt_budget"))
            .agg(
                F.sum(x).alias("amt_jtd"), F.sum(x * (1 + tax)).alias("amt_ecac"), F.sum(x).alias("amt_projected"),
                (F.sum(x * tax) - F.sum(F.when(disc > 0.09, 5000).otherwise(0))).alias("amt_ftc"), F.sum(x).alias("amt_original"), F.sum(x * tax).alias("amt_in"),
                (-F.sum(x * disc)).alias("amt_out"), (F.sum(x * (1 + tax - disc)) + F.sum(F.when(F.col("l_quantity") < 3, 900).otherwise(0))).alias("amt_revised"),
            )
        )


def tables(v, stored: bool = False) -> Generated:
    return Generated(v, stored)


def _open():
    return F.col("l_linestatus") != "F"


def code(order, extra=None):
    tail = F.when(order % 3 == 0, "-BL").otherwise("-RB")
    return F.concat(order.cast("string"), F.when(extra, "-XX").otherwise(tail) if extra is not None else tail)


BL = "code LIKE '%-BL'"


def cnt(table, where="true"):
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def orphan(child, parent, key, pkey=None, where="true"):
    return f"(SELECT count(*) FROM {child} c WHERE {where} AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pkey or key} = c.{key}))"


def trans(table, keys):
    return f"(SELECT greatest(1, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table}))) FROM {table})"


def lagged(table, keys, order, x, eps):
    return f"(SELECT count(*) FROM (SELECT {x} AS x, lag({x}) OVER (PARTITION BY {keys} ORDER BY {order}) AS p FROM {table}) WHERE x < p - {eps})"


PCT = "CASE WHEN n_total > 0 THEN n_completed / CAST(n_total AS DOUBLE) ELSE 0 END"
ACTIVE_TCO = "(SELECT entity_id, dt_tco AS last_tco FROM vs WHERE is_active)"
NEAR = """(SELECT count(*) FROM ve e WHERE is_near AND coalesce((SELECT min(abs(date_diff('day', s.effective_from, e.created))) FROM vs s WHERE s.entity_id = e.entity_id AND s.code NOT LIKE '%-BL'), 999999) > 60)"""


def recon(a, b):
    base = f"(SELECT coalesce(x.n, 0) AS a, coalesce(y.n, 0) AS b FROM ({a}) x FULL JOIN ({b}) y ON x.entity_id = y.entity_id)"
    return f"(SELECT count(*) FROM {base})", f"(SELECT count(*) FROM {base} WHERE a <> b)"


RB = recon("SELECT entity_id, count(*) - 1 AS n FROM vs GROUP BY 1", "SELECT entity_id, count(*) AS n FROM vr GROUP BY 1")
VM = recon("SELECT entity_id, count(DISTINCT code) AS n FROM vt GROUP BY 1", "SELECT entity_id, count(*) AS n FROM vs GROUP BY 1")
SCALE = "(SELECT e.entity_id, n / (amt_contract / 1e6) AS r FROM (SELECT entity_id, count(*) AS n FROM ve GROUP BY 1) e JOIN vp USING (entity_id))"
UNITS = ", ".join(f"('{u}')" for u in values.BUSINESS_UNITS)
SQLS = {
    "REF_SCHED_TO_PROJECT": (cnt("vs"), orphan("vs", "vp", "entity_id")),
    "REF_TASK_TO_PROJECT": (cnt("vt"), orphan("vt", "vp", "entity_id")),
    "REF_TASK_TO_SCHEDULE": (cnt("vt"), orphan("vt", "vs", "code")),
    "REF_RFI_TO_PROJECT": (cnt("ve"), orphan("ve", "vp", "entity_id")),
    "REF_RFI_CHAIN_PARENT": (cnt("ve", "parent_id IS NOT NULL"), orphan("ve", "ve", "parent_id", "event_id", "c.parent_id IS NOT NULL")),
    "REF_BUDGET_TO_PROJECT": (cnt("vb"), orphan("vb", "vp", "entity_id")),
    "REF_REBASELINE_TO_PROJECT": (cnt("vr"), orphan("vr", "vp", "entity_id")),
    "TEMP_SCHED_ONE_ACTIVE": (cnt("vp"), "(SELECT count(*) FROM vp p WHERE (SELECT count(*) FROM vs s WHERE s.is_active AND s.entity_id = p.entity_id) <> 1)"),
    "TEMP_SCD2_NO_OVERLAP": (cnt("vs"), "(SELECT count(*) FROM (SELECT effective_to, lead(effective_from) OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS n FROM vs) WHERE effective_to > n)"),
    "TEMP_TCO_MONOTONIC": (trans("vs", "entity_id"), "(SELECT count(*) FROM (SELECT dt_tco, lag(dt_tco) OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS p FROM vs) WHERE dt_tco < p)"),
    "TEMP_NTP_BEFORE_TCO": (cnt("vs"), cnt("vs", "dt_ntp > dt_tco")),
    "TEMP_SOW_IN_PROJECT_RANGE": (cnt("vt"), "(SELECT count(*) FROM vt t JOIN vs s ON s.code = t.code JOIN vp p ON p.entity_id = t.entity_id WHERE t.sow_start < p.dt_start - 90 OR t.sow_finish > s.dt_tco + 90)"),
    "TEMP_BASELINE_ZERO_COMPLETION": (cnt("vt", BL), cnt("vt", BL + " AND n_completed > 0")),
    "TEMP_COMPLETION_PROGRESSION": (trans("vt", "entity_id, sow"), lagged(f"(SELECT *, {PCT} AS pct FROM vt)", "entity_id, sow", "effective_from, code", "pct", "0.01")),
    "TEMP_RFI_IN_PROJECT_RANGE": (cnt("ve"), "(SELECT count(*) FROM ve JOIN vp USING (entity_id) WHERE created < dt_start - 30 OR created > dt_end + 30)"),
    "TEMP_RFI_DUE_AFTER_CREATED": (cnt("ve"), cnt("ve", "due < created")),
    "TEMP_RFI_RESOLVED_AFTER_CREATED": (cnt("ve", "resolved IS NOT NULL"), cnt("ve", "resolved < created")),
    "TEMP_BUDGET_IN_PROJECT_RANGE": (f"(SELECT count(*) FROM vb JOIN vp USING (entity_id) LEFT JOIN {ACTIVE_TCO} USING (entity_id))", f"(SELECT count(*) FROM vb JOIN vp USING (entity_id) LEFT JOIN {ACTIVE_TCO} USING (entity_id) WHERE dt_budget < dt_start - 90 OR dt_budget > last_tco + 90)"),
    "TEMP_BUDGET_JTD_MONOTONIC": (trans("vb", "entity_id, division, cost_code"), lagged("vb", "entity_id, division, cost_code", "dt_budget", "amt_jtd", "0.01")),
    "DOMAIN_RFI_STATUS_RESOLVED": (cnt("ve", "status IN ('open', 'overdue', 'draft')"), cnt("ve", "status IN ('open', 'overdue', 'draft') AND resolved IS NOT NULL")),
    "DOMAIN_RFI_CLOSED_HAS_RESOLVED": (cnt("ve", "status = 'closed'"), cnt("ve", "status = 'closed' AND resolved IS NULL")),
    "DOMAIN_BUDGET_FTC_NONNEG": (cnt("vb"), cnt("vb", "amt_ftc < -0.01")),
    "DOMAIN_BUDGET_ECAC_IDENTITY": (cnt("vb"), cnt("vb", "abs(amt_ecac - (amt_projected + amt_ftc)) > greatest(abs(amt_ecac) * 0.01, 1000)")),
    "DOMAIN_BUDGET_REVISED_CALC": (cnt("vb"), cnt("vb", "abs(amt_revised - (amt_original + amt_in + amt_out)) > greatest(abs(amt_revised) * 0.01, 100)")),
    "DOMAIN_TASK_ONE_ACTIVE_VERSION": (cnt("vp"), "(SELECT count(*) FROM (SELECT entity_id FROM vt WHERE is_active GROUP BY 1 HAVING count(DISTINCT code) <> 1))"),
    "DOMAIN_TASK_COUNT_IDENTITY": (cnt("vt"), cnt("vt", "n_total <> n_completed + n_active + n_not_started")),
    "DOMAIN_TASK_PCT_RANGE": (cnt("vt"), cnt("vt", f"{PCT} < -0.001 OR {PCT} > 1.001")),
    "DOMAIN_SCHED_HAS_BASELINE": (cnt("vp"), f"(SELECT greatest(0, {cnt('vp')} - count(DISTINCT entity_id)) FROM vs WHERE {BL})"),
    "DOMAIN_PROJ_DATE_ORDER": (cnt("vp"), cnt("vp", "dt_end < dt_start")),
    "DOMAIN_PROJ_POSITIVE_AMOUNTS": (cnt("vp"), cnt("vp", "amt_contract <= 0 OR gross_area <= 0")),
    "DOMAIN_RFI_VALID_TIMING": (cnt("ve"), cnt("ve", "timing NOT IN ('Pre-SOW', 'During', 'Post-SOW')")),
    "DOMAIN_RFI_VALID_TRADE": (cnt("ve"), cnt("ve", "trade = 'OTHER'")),
    "CROSS_RFI_REBASELINE_FLAG": (cnt("ve", "is_near"), NEAR),
    "CROSS_SCHED_RB_COUNT_MATCH": RB,
    "CROSS_RFI_SIZE_SCALING": (cnt(SCALE), cnt(SCALE, "r < 1 OR r > 100")),
    "CROSS_TASK_SCHED_VERSION_MATCH": VM,
    "CROSS_BUDGET_PROJECT_COVERAGE": (cnt("vp"), f"({cnt('vp')} - (SELECT count(DISTINCT entity_id) FROM vb))"),
    "CARD_ALL_SBUS_PRESENT": ("7", f"(SELECT count(*) FROM (SELECT * FROM (VALUES {UNITS}) u(s) EXCEPT SELECT lower(trim(sbu)) FROM vp))"),
    "CARD_SCHED_AVG_VERSIONS": ("1", f"CASE WHEN {cnt('vs')} / CAST({cnt('vp')} AS DOUBLE) BETWEEN 1.5 AND 4.0 THEN 0 ELSE 1 END"),
    "CARD_TASK_AVG_SOWS": ("1", "(SELECT CASE WHEN avg(n) BETWEEN 15 AND 30 THEN 0 ELSE 1 END FROM (SELECT count(DISTINCT sow) AS n FROM vt WHERE is_active GROUP BY entity_id))"),
    "CARD_RFI_STATUS_DIST": ("1", "(SELECT CASE WHEN count(*) FILTER (WHERE status = 'closed') * 100 / CAST(count(*) AS DOUBLE) BETWEEN 50 AND 95 THEN 0 ELSE 1 END FROM ve)"),
    "CARD_BUDGET_DIVISIONS": ("(SELECT count(DISTINCT division) FROM vb)", "0"),
}


def result_sql(check_id: str) -> str:
    c = checks.BY_ID[check_id]
    total, bad = SQLS[check_id]
    limit = {"HARD": "violations = 0", "SOFT": "CASE WHEN total_checked > 0 THEN violations / CAST(total_checked AS DOUBLE) <= 0.05 ELSE true END", "INFO": "true"}[c.severity]
    return f"""SELECT '{check_id}' AS check_id, '{c.layer}' AS layer, '{c.category}' AS category, '{c.severity}' AS severity, total_checked, violations,
 round(CASE WHEN total_checked > 0 THEN violations / CAST(total_checked AS DOUBLE) ELSE 0 END * 100, 3) AS violation_pct, {limit} AS passed FROM (SELECT CAST({total} AS BIGINT) AS total_checked, CAST({bad} AS BIGINT) AS violations)"""


NEEDED = ("project", "version")
for _i, _c in enumerate(checks.CHECKS, start=1):
    def _bound(v, _id=_c.check_id):
        return checks.run(tables(v), [_id])

    query(f"V{_i}_{_c.check_id}", with_(*NEEDED, extra=V, body=result_sql(_c.check_id)))(_bound)

RESULTS = V + ",\nres AS (" + "\nUNION ALL ".join(result_sql(c.check_id) for c in checks.CHECKS) + ")"
CARD = "count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed, count(*) FILTER (WHERE NOT passed AND severity <> 'INFO') AS n_failed FROM res"


@query("V43_scorecard", with_(*NEEDED, extra=RESULTS, body=f"""
SELECT 'overall' AS scope, 'all' AS name, {CARD} UNION ALL SELECT 'severity', severity, {CARD} GROUP BY 2 UNION ALL SELECT 'category', category, {CARD} GROUP BY 2"""))
def _(v):
    return checks.scorecard(checks.run(tables(v, stored=True)))
