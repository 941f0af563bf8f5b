"""Generated rows of the folding generators as SQL: every draw repeated by its MD5 hash, every fold as a recursion.

The profile tables that the generators read are built from the views here too, so a query's rows follow from the given tables alone.
"""

from sigloom.bindings import profiling_events as pe
from sigloom.bindings import profiling_versions as pv
from sigloom.bindings import profiling_work as pw
from sigloom.bindings.views import with_
from sigloom.functions import draws, values
from sigloom.plans import gen_versions as gv


def u(keys, purpose: str, low: float | None = None, high: float | None = None) -> str:
    text = draws.uniform_sql(keys, purpose)
    return text if low is None else f"({low!r}::DOUBLE + ({high!r}::DOUBLE - {low!r}::DOUBLE) * {text})"


def triangular(u: str, low: str, mode: str, high: str) -> str:
    """Inverse CDF over columns; a zero-width triangle gives its mode."""
    a, b = f"least({low}, {mode})", f"greatest({high}, {mode})"
    width = f"({b} - {a})"
    return (
        f"CASE WHEN {width} <= 0 THEN {mode} WHEN {u} < ({mode} - {a}) / {width} THEN {a} + sqrt({u} * {width} * ({mode} - {a}))"
        f" ELSE {b} - sqrt((1 - {u}) * {width} * ({b} - {mode})) END"
    )


def first_level(rows: str, table: str, key: str, levels, take, condition: str = "true") -> str:
    """The table's row of the first level that matches, for each row; levels are (name, keys, least count or none)."""
    any_of = " OR ".join(
        "(p.level = '" + name + "'" + (f" AND p.{least[0]} >= {least[1]}" if least else "") + "".join(f" AND p.{k} = e.{k}" for k in keys) + ")" for name, keys, least in levels
    )
    rank = "CASE p.level " + " ".join(f"WHEN '{name}' THEN {i}" for i, (name, *_) in enumerate(levels)) + " END"
    return f"SELECT e.{key}, {', '.join('p.' + t for t in take)} FROM {rows} e JOIN {table} p ON {condition} AND ({any_of}) QUALIFY row_number() OVER (PARTITION BY e.{key} ORDER BY {rank}) = 1"


ENOUGH = ("n_projects", 5)
PROFILE = [("SBU_CONTRACT", ("sbu", "contract_bucket"), ENOUGH), ("SBU_SIZE", ("sbu", "size_category"), ENOUGH), ("SBU_ASSET", ("sbu", "asset"), ENOUGH), ("SBU", ("sbu",), None), ("GLOBAL", (), None)]
DELAYS = [("SBU_CONTRACT", ("sbu", "contract_bucket"), None), ("SBU_SIZE", ("sbu", "size_category"), None), ("SBU", ("sbu",), None), ("GLOBAL", (), None)]
Q = ("p25", "median", "p75")

PROFILES = pv.VERS + "," + pv.MS + f""",
en AS (SELECT * FROM project WHERE dt_end > dt_start),
pr AS (SELECT level, sbu, size_category, contract_bucket, asset, 'n_rebaselines' AS field, n_projects, CAST(p25 AS DOUBLE) AS p25, CAST(median AS DOUBLE) AS median, CAST(p75 AS DOUBLE) AS p75, CAST(p99 AS DOUBLE) AS p99, CAST(max AS DOUBLE) AS max, mean FROM ({pv.COUNT_SQL})
 UNION ALL SELECT level, sbu, NULL, NULL, asset, field, n, p25, median, p75, p99, max, mean FROM ({pv.MS_SQL}))"""


def offset(prefix: str, purpose: str, floor: int | None) -> str:
    """Whole days of a triangular draw with a floor and jitter."""
    m, p25, p75 = f"{prefix}.median", f"{prefix}.p25", f"{prefix}.p75"
    low = f"(CASE WHEN {p25} = {m} AND {p75} <> {m} THEN {m} - 5 ELSE {p25} END)"
    high = f"(CASE WHEN {p75} = {m} AND {p25} <> {m} THEN {m} + 5 ELSE {p75} END)"
    v = f"coalesce({triangular(u(['e.entity_id'], purpose), low, m, high)}, {float(floor or 0)!r}::DOUBLE)"
    v = f"greatest({v}, {float(floor)!r}::DOUBLE)" if floor is not None else v
    return f"CAST(trunc({v} * (1 + {u(['e.entity_id'], purpose + ':jitter', -0.06, 0.06)})) AS INTEGER)"


OFFSETS = f""",
oc AS ({first_level('en', 'pr', 'entity_id', PROFILE, Q, "p.field = 'tco_to_co_days'")}),
ox AS ({first_level('en', 'pr', 'entity_id', PROFILE, Q, "p.field = 'tco_to_next_tco_days'")}),
os AS (SELECT e.entity_id, {offset('oc', 'co', gv.MIN_CLOSE_DAYS)} AS co_offset, CASE WHEN {u(['e.entity_id'], 'has_next')} < {gv.NEXT_TARGET_SHARE!r}::DOUBLE THEN {offset('ox', 'next', None)} END AS next_offset
 FROM en e LEFT JOIN oc USING (entity_id) LEFT JOIN ox USING (entity_id))"""

G15 = with_("version", "project", "entity", extra=PROFILES + OFFSETS, body="SELECT * FROM os")


def shares(mapping, u: str) -> str:
    """The first item whose cumulative weight is above u times the total."""
    total = 0.0
    cums = []
    for name, w in mapping.items():
        total += float(w)
        cums.append((name, total))
    whens = " ".join(f"WHEN {u} * {total!r}::DOUBLE < {c!r}::DOUBLE THEN '{n}'" for n, c in cums[:-1])
    return f"CASE {whens} ELSE '{cums[-1][0]}' END"


def case_of(column: str, mapping) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items()) + " END"


KEY = ["entity_id", "i"]
DELAY = """CASE WHEN NOT known THEN fixed_days ELSE CAST(trunc(greatest(least(CASE WHEN v > p95 THEN p95 * (1 + u_over * 0.2::DOUBLE) ELSE v * (1 + (u_jitter * 2 - 1) * 0.06::DOUBLE) END, p99), 7.0::DOUBLE)) AS INTEGER) END"""
VERSIONS = PROFILES + OFFSETS + f""",
ol AS ({first_level('en', 'pr', 'entity_id', PROFILE, ('mean', 'p99', 'max'), "p.field = 'n_rebaselines'")}),
lm AS (SELECT e.entity_id, {u(['e.entity_id'], 'n_rebaselines')} AS u, coalesce(mean, 0) AS lam, CAST(floor(least(p99, max)) AS INTEGER) AS cap FROM en e LEFT JOIN ol USING (entity_id)),
po AS (SELECT entity_id, u, lam, 0 AS k, exp(-lam) AS pmf, exp(-lam) AS cdf FROM lm WHERE lam > 0 UNION ALL SELECT entity_id, u, lam, k + 1, pmf * lam / (k + 1), cdf + pmf * lam / (k + 1) FROM po WHERE u >= cdf AND k < 400),
ct AS (SELECT entity_id, CAST(greatest(0, least(coalesce(k, 0), cap)) AS INTEGER) AS n FROM lm LEFT JOIN (SELECT entity_id, max(k) AS k FROM po GROUP BY 1) USING (entity_id)),
tq AS (SELECT rebaseline_number AS slot, quantile_disc(timing, 0.25) AS p25, quantile_disc(timing, 0.5) AS p50, quantile_disc(timing, 0.75) AS p75 FROM tm GROUP BY 1),
dr AS (SELECT e.*, t.i FROM en e JOIN ct USING (entity_id), unnest(range(1, ct.n + 1)) AS t(i)),
d1 AS (SELECT d.entity_id, d.i, d.sbu, d.size_category, d.contract_bucket, coalesce(least(1.0::DOUBLE, greatest(0.0::DOUBLE, {triangular(u(['d.entity_id', 'd.i'], 'timing'), 'q.p25', 'q.p50', 'q.p75')})), {case_of('least(d.i, 5)', values.TIMING_DEFAULTS)}, 0.5)::DOUBLE AS t,
 {shares(values.DELAY_SHARES, u(['d.entity_id', 'd.i'], 'category'))} AS severity, d.entity_id || '|' || d.i AS id FROM dr d LEFT JOIN tq q ON q.slot = least(d.i, 5)),
dp AS ({pv.DELAY_SQL}),
dh AS ({first_level('d1', 'dp', 'id', DELAYS, (*Q, 'p95', 'p99'), 'p.severity = e.severity')}),
d2 AS (SELECT entity_id, i, t, severity, dh.id IS NOT NULL AS known, {triangular(u(KEY, 'delay'), 'dh.p25', 'dh.median', 'dh.p75')} AS raw, dh.p95::DOUBLE AS p95, dh.p99::DOUBLE AS p99, {case_of('severity', values.DELAY_MIDPOINTS)} AS fixed_days,
 {u(KEY, 'delay:slack')} AS u_slack, {u(KEY, 'delay:over')} AS u_over, {u(KEY, 'delay:jitter')} AS u_jitter, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY t, i) AS INTEGER) AS k FROM d1 LEFT JOIN dh USING (id)),
wk AS (SELECT entity_id, 0 AS k, 0.0::DOUBLE AS t, NULL::DATE AS date, dt_end AS target, 0 AS delay, NULL::VARCHAR AS category, dt_start, dt_end FROM en
 UNION ALL SELECT entity_id, k, t, date, target + {DELAY}, {DELAY}, severity, dt_start, dt_end FROM (
  SELECT *, CASE WHEN slack > 0 AND raw > slack * 0.9::DOUBLE THEN slack * 0.9::DOUBLE * (1 + u_slack * 0.2::DOUBLE) ELSE raw END AS v FROM (
   SELECT *, CAST(CASE WHEN date_diff('day', date, target) <= 0 THEN 30 ELSE date_diff('day', date, target) END AS DOUBLE) AS slack FROM (
    SELECT * REPLACE (CASE WHEN before IS NOT NULL AND date <= before THEN before + 1 ELSE date END AS date) FROM (
     SELECT w.entity_id, d.k, least(0.95::DOUBLE, greatest(d.t, w.t + 0.05::DOUBLE)) AS t, w.date AS before, w.target, d.severity, d.known, d.raw, d.p95, d.p99, d.fixed_days, d.u_slack, d.u_over, d.u_jitter, w.dt_start, w.dt_end,
      w.dt_start + CAST(trunc(date_diff('day', w.dt_start, w.dt_end) * least(0.95::DOUBLE, greatest(d.t, w.t + 0.05::DOUBLE))) AS INTEGER) AS date FROM wk w JOIN d2 d ON d.entity_id = w.entity_id AND d.k = w.k + 1))))),
vd AS (SELECT w.* REPLACE (coalesce(w.date, w.dt_start - {gv.BASELINE_LEAD_DAYS}) AS date), c.n, o.co_offset, o.next_offset FROM wk w JOIN ct c USING (entity_id) JOIN os o USING (entity_id))"""

G13 = with_("version", "project", "entity", extra=VERSIONS, body=f"""
SELECT entity_id, entity_id || CASE WHEN k = 0 THEN '-000.01-BL' ELSE '-' || lpad(k::VARCHAR, 3, '0') || '.MO-RB' END AS code, k AS version, dt_start AS dt_ntp, target AS dt_tco, target + next_offset AS dt_next_tco, target + co_offset AS dt_co,
 n + 1 - k AS n_recent, date AS effective_from, CASE WHEN k = n THEN DATE '{values.OPEN_END}' ELSE greatest(date, lead(date) OVER (PARTITION BY entity_id ORDER BY k) - 1) END AS effective_to, k = n AS is_active, delay AS delay_days, category AS delay_category, dt_end AS dt_tco_original
FROM vd""").replace("WITH ", "WITH RECURSIVE ", 1)


# work packages


def from_bounds(keys, purpose: str, p25: str, median: str, p75: str, p95: str | None = None) -> str:
    """Triangular draw with jitter and cap; a side that equals the median is opened by a half, unless both do."""
    lo, hi = f"coalesce({p25}, {median})", f"coalesce({p75}, {median})"
    a = f"(CASE WHEN {lo} >= {median} THEN greatest(0, {median} - 0.5::DOUBLE) ELSE {lo} END)"
    b = f"(CASE WHEN {hi} <= {median} THEN {median} + 0.5::DOUBLE ELSE {hi} END)"
    v = f"({triangular(u(keys, purpose), a, median, b)}) * (1 + {u(keys, purpose + ':jitter', -0.05, 0.05)})"
    return f"CASE WHEN {lo} = {median} AND {hi} = {median} THEN {median} ELSE {f'least({v}, {p95})' if p95 else v} END"


def doubles(names, sql: str, more: str) -> str:
    return f"SELECT {more}, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in names)} FROM ({sql})"


WORKED = [("SBU_CONTRACT", ("sbu", "contract_bucket"), ENOUGH), ("SBU_SIZE", ("sbu", "size_category"), ENOUGH), ("SBU", ("sbu",), None)]
SOW = ["entity_id", "sow"]
POSITION = [("SOW_SBU", ("sow", "sbu"), None), ("GLOBAL", ("sow",), None)]
SPAN = [("SOW_SBU", ("sbu", "sow"), None), ("SOW_TYPE", ("sow",), None)]
LABEL = "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(c.sow, {w!r})' for w in words)} THEN {place}" for words, place in values.LABEL_POSITIONS) + f" ELSE {values.LABEL_POSITION_DEFAULT} END"
ANCHORED = "CASE c.sow " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.ANCHOR_POSITIONS.items()) + " END"

CHOSEN = pw.WORK + f""",
en AS (SELECT * FROM project WHERE dt_end > dt_start),
np AS ({doubles(Q, pw.SOW_COUNT_SQL, 'level, sbu, size_category, contract_bucket, n_projects')}),
nb AS ({first_level('en', 'np', 'entity_id', WORKED, Q)}),
nn AS (SELECT e.*, CAST(least(40, greatest(5, round(coalesce({from_bounds(['e.entity_id'], 'n_sows', 'nb.p25', 'nb.median', 'nb.p75')}, 20)))) AS INTEGER) AS n FROM en e LEFT JOIN nb USING (entity_id)),
fr AS (SELECT sbu, sow, round(count(DISTINCT entity_id) * CAST(100 AS DOUBLE) / (SELECT count(DISTINCT entity_id) FROM w x WHERE x.sbu = w.sbu), 2) AS pct FROM w GROUP BY 1, 2),
mn AS (SELECT sbu, sow, pct FROM fr UNION ALL SELECT e.sbu, f.sow, f.pct FROM (SELECT DISTINCT sbu FROM en WHERE sbu NOT IN (SELECT sbu FROM fr)) e, (SELECT sow, avg(pct) AS pct FROM fr GROUP BY 1) f),
ch AS (SELECT * FROM (SELECT e.*, m.sow, row_number() OVER (PARTITION BY e.entity_id ORDER BY -ln({u(['e.entity_id', 'm.sow'], 'choose')}) / m.pct, m.sow) AS r FROM nn e JOIN mn m ON m.sbu = e.sbu) WHERE r <= n),
ci AS (SELECT *, entity_id || '|' || sow AS id FROM ch),
sq AS (SELECT 'SOW_SBU' AS level, sow, sbu, avg(seq) AS mean, stddev_samp(seq) AS stddev, CAST(min(seq) AS DOUBLE) AS min, CAST(max(seq) AS DOUBLE) AS max FROM w GROUP BY sow, sbu HAVING count(DISTINCT entity_id) >= 5
 UNION ALL SELECT 'GLOBAL', sow, NULL, avg(seq), stddev_samp(seq), min(seq), max(seq) FROM w GROUP BY sow HAVING count(DISTINCT entity_id) >= 10),
sb AS ({first_level('ci', 'sq', 'id', POSITION, ('mean', 'stddev', 'min', 'max'))}),
po AS (SELECT c.*, coalesce({ANCHORED}, CASE WHEN sb.id IS NOT NULL THEN least(greatest(round({draws.normal_sql(['c.entity_id', 'c.sow'], 'position')} * coalesce(sb.stddev, 3) + coalesce(sb.mean, 10)), coalesce(sb.min, 1)), coalesce(sb.max, 30)) ELSE {LABEL} END) AS pos
 FROM ci c LEFT JOIN sb USING (id)),
ar AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY pos, {u(SOW, 'position:tie')}) AS INTEGER) AS place, count(*) OVER (PARTITION BY entity_id) AS n_sows FROM po)"""

G17 = with_("project", "task", extra=CHOSEN, body="SELECT entity_id, sow, place AS seq, n_sows FROM ar")

PLACED = CHOSEN + "," + pw.PAIRS.removeprefix(pw.WORK + ",") + f""",
dq AS ({doubles((*Q, 'p95'), pw.DUR_SQL, 'level, sow, sbu')}),
db AS ({first_level('ar', 'dq', 'id', SPAN, (*Q, 'p95'))}),
du AS (SELECT a.*, dt_end AS boundary, CAST(least(1000, greatest(30, round(coalesce({from_bounds(['a.entity_id', 'a.sow'], 'duration', 'db.p25', 'db.median', 'db.p75', 'db.p95')}, 180)))) AS INTEGER) AS days, lag(sow) OVER (PARTITION BY entity_id ORDER BY place) AS before FROM ar a LEFT JOIN db USING (id)),
ge AS (SELECT quantile_disc(overlap_pct, 0.25) AS p25, quantile_disc(overlap_pct, 0.5) AS median, quantile_disc(overlap_pct, 0.75) AS p75 FROM cp),
pp AS (SELECT sow_first, sow_second, quantile_disc(overlap_pct, 0.25) AS p25, quantile_disc(overlap_pct, 0.5) AS median, quantile_disc(overlap_pct, 0.75) AS p75 FROM cp GROUP BY 1, 2 HAVING count(*) >= 5),
ov AS (SELECT * EXCLUDE (p25, median, p75), least(100, greatest(-50, coalesce({triangular(u(SOW, 'overlap'), 'p25', 'median', 'p75')}, 84))) / 100.0::DOUBLE AS overlap FROM
 (SELECT d.*, coalesce(p.p25, g.p25) AS p25, coalesce(p.median, g.median) AS median, coalesce(p.p75, g.p75) AS p75 FROM du d LEFT JOIN pp p ON p.sow_first = d.before AND p.sow_second = d.sow, ge g)),
wp AS (SELECT entity_id, place, dt_start AS start, days FROM ov WHERE place = 1
 UNION ALL SELECT entity_id, place, CASE WHEN start > boundary + 60 THEN boundary - 60 ELSE start END, days FROM (
  SELECT o.entity_id, o.place, o.boundary, o.days, p.start + greatest(0, CAST(trunc(p.days * (1 - o.overlap)) AS INTEGER)) AS start FROM wp p JOIN ov o ON o.entity_id = p.entity_id AND o.place = p.place + 1)),
pl AS (SELECT o.*, p.start, p.start + o.days AS finish FROM ov o JOIN wp p USING (entity_id, place))"""

G18 = with_("project", "task", extra=PLACED, body="SELECT entity_id, sow, place AS seq, start AS sow_start, finish AS sow_finish, days AS sow_days, overlap FROM pl").replace("WITH ", "WITH RECURSIVE ", 1)


def overrun(i: int) -> str:
    return "CASE sow " + " ".join(f"WHEN '{k}' THEN {v[i]!r}::DOUBLE" for k, v in values.OVERRUNS.items()) + " END"


CLIPPED = PLACED + f""",
sc AS (SELECT *, CASE WHEN last > boundary AND date_diff('day', dt_start, boundary) > 0 AND date_diff('day', dt_start, last) > 0
  THEN greatest(date_diff('day', dt_start, boundary) / CAST(date_diff('day', dt_start, last) AS DOUBLE), 0.5) ELSE 1 END AS f FROM (SELECT *, max(finish) OVER (PARTITION BY entity_id) AS last FROM pl)),
s2 AS (SELECT * REPLACE (CASE WHEN last > boundary THEN dt_start + greatest(0, CAST(trunc(date_diff('day', dt_start, start) * f) AS INTEGER)) ELSE start END AS start, CASE WHEN last > boundary THEN greatest(30, CAST(trunc(days * f) AS INTEGER)) ELSE days END AS days), f < 0.99 AS was_scaled FROM sc),
s3 AS (SELECT * REPLACE (start + days AS finish) FROM s2),
s4 AS (SELECT *, coalesce(chance IS NOT NULL AND (date_diff('day', boundary, finish) > -30 OR (was_scaled AND place - 1 >= floor(n_sows * 0.6::DOUBLE))) AND {u(SOW, 'overrun')} < chance, false) AS hit,
 CAST(greatest(7, trunc({triangular(u(SOW, 'overrun:days'), '7.0::DOUBLE', 'mode', 'longest')})) AS INTEGER) AS over FROM (SELECT *, {overrun(0)} AS chance, {overrun(1)} AS mode, {overrun(2)} AS longest FROM s3)),
s5 AS (SELECT entity_id, sow, place AS seq, CASE WHEN NOT hit AND finish > boundary AND start >= boundary THEN boundary - 30 ELSE start END AS sow_start, CASE WHEN hit THEN boundary + over WHEN finish > boundary THEN boundary ELSE finish END AS sow_finish, boundary FROM s4)"""

G20 = with_("project", "task", extra=CLIPPED, body="SELECT entity_id, sow, seq, sow_start, sow_finish, CAST(date_diff('day', sow_start, sow_finish) AS INTEGER) AS sow_days, boundary FROM s5").replace("WITH ", "WITH RECURSIVE ", 1)


# events

COUNTED = [("SBU_SIZE", ("sbu", "size_category"), None), ("SBU", ("sbu",), None), ("GLOBAL", (), None)]
COUNT = {k: f"coalesce(b.{k}, {values.DEFAULT_COUNT_BOUNDS[k]!r})::DOUBLE AS {k}" for k in Q}
SPIKE = {k: repr(v) + "::DOUBLE" for k, v in values.DEFAULT_SPIKE_BOUNDS.items()}


def lognormal(purpose: str, p25: str, median: str, p75: str, shift: str) -> str:
    sigma = f"((ln({p75} + {shift}) - ln({p25} + {shift})) / (2 * 0.6745::DOUBLE))"
    return f"exp(ln({median} + {shift}) + {sigma} * {draws.normal_sql(['entity_id'], purpose)})"


G30 = with_("event", "event_project", extra=pe.CNT + f""",
es AS (SELECT entity_id, sbu, CASE WHEN duration < 29 THEN 'short' ELSE 'long' END AS size_category FROM event_project),
cp AS ({pe.CNT_SQL}),
cb AS ({first_level('es', 'cp', 'entity_id', COUNTED, Q)}),
cq AS (SELECT e.entity_id, {', '.join(COUNT.values())} FROM es e LEFT JOIN cb b USING (entity_id)),
cn AS (SELECT *, floor(p75 * 1.15::DOUBLE) AS cap, {lognormal('n_events', 'p25', 'median', 'p75', '1.0::DOUBLE')} AS v,
 least(2.0::DOUBLE, greatest(0.5::DOUBLE, {lognormal('spike', SPIKE['p25'], SPIKE['median'], SPIKE['p75'], '0.01::DOUBLE')})) AS lift, entity_id IN (SELECT entity_id FROM event WHERE trade = 'error') AS has FROM cq),
cm AS (SELECT *, greatest(1, least(floor(v), cap)) AS n FROM cn)""", body="""
SELECT entity_id, CAST(CASE WHEN has THEN greatest(1, least(trunc(n * lift), cap)) ELSE n END AS INTEGER) AS n_events FROM cm""")
