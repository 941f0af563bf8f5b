"""Role bindings: the test tables seen as entities, versions, tasks, ledgers and events.

Each view exists twice, as a DataFrame and as an SQL common table expression with the same
columns; the SQL text is only used to check the DataFrame results.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.functions import buckets
from sigloom.session import ensure_checkpoint_dir
from sigloom.sources.tables import overwrite, scan

_STORED: dict[tuple[str, str, str], str] = {}

# role parameters of the test tables
AREA_EDGES = (500.0, 1000.0, 1500.0)
AMOUNT_EDGES = (1_500_000.0, 2_500_000.0, 3_500_000.0)
SIZE = ("Small", "Medium", "Large", "XLarge")
AMOUNT = ("Medium", "Large", "XLarge", "XXLarge")


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def stored(self, name: str, make) -> DataFrame:
        """A profile table: computed and written once per session, then read, as generation does."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STORED:
            where = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/sigloom-{name}-{uuid.uuid4().hex}"
            overwrite(make(), where)
            _STORED[key] = where
        return scan(self.spark, _STORED[key])

    def is_stored(self, name: str) -> bool:
        return (self.spark.sparkContext.applicationId, self.sf_dir, name) in _STORED

    def table(self, name: str, *columns: str) -> DataFrame:
        return scan(self.spark, f"{self.sf_dir}/{name}.parquet", columns or None)

    @cached_property
    def entity(self) -> DataFrame:
        """One row per order. Line items are reduced per order before they are joined."""
        lines = (
            self.table("lineitem", "l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate")
            .groupBy("l_orderkey")
            .agg(
                F.sum("l_quantity").alias("gross_area"),
                F.round(F.sum("l_extendedprice"), 2).alias("amt_cost"),
                F.count(F.lit(1)).alias("n_floors"),
                F.to_date(F.max("l_shipdate")).alias("dt_end"),
            )
        )
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("entity_id"),
            F.col("o_custkey").alias("cust_id"),
            F.col("o_orderpriority").alias("asset"),
            F.col("o_totalprice").alias("amt_contract"),
            F.to_date("o_orderdate").alias("dt_start"),
            F.col("o_orderstatus").alias("status"),
        )
        cust = self.table("customer", "c_custkey", "c_mktsegment", "c_nationkey").select(
            F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("sbu"), "c_nationkey"
        )
        nation = self.table("nation", "n_nationkey", "n_name").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("region")
        )
        return (
            orders.join(lines.withColumnRenamed("l_orderkey", "entity_id"), "entity_id", "left")
            .join(cust.join(nation, "c_nationkey"), "cust_id")
            .select(
                "entity_id", "cust_id", "sbu", "asset", "region", "amt_contract", "gross_area", "amt_cost",
                "n_floors", "dt_start", "dt_end", "status",
            )
        )

    @cached_property
    def project(self) -> DataFrame:
        """One row per customer that has orders."""
        lines = (
            self.table("lineitem", "l_orderkey", "l_quantity", "l_extendedprice", "l_shipdate")
            .groupBy("l_orderkey")
            .agg(
                F.sum("l_quantity").alias("q"),
                F.sum("l_extendedprice").alias("x"),
                F.max("l_shipdate").alias("m"),
            )
        )
        per = (
            self.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .groupBy(F.col("o_custkey").alias("entity_id"))
            .agg(
                F.round(F.sum("o_totalprice"), 2).alias("amt_contract"),
                F.sum("q").alias("gross_area"),
                F.round(F.sum("x"), 2).alias("amt_cost"),
                F.to_date(F.min("o_orderdate")).alias("dt_start"),
                F.to_date(F.max("m")).alias("dt_end"),
                F.count(F.lit(1)).alias("n_orders"),
            )
        )
        dims = (
            self.table("customer", "c_custkey", "c_mktsegment", "c_nationkey")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("entity_id"),
                F.col("c_mktsegment").alias("sbu"),
                F.col("r_name").alias("asset"),
                F.col("n_name").alias("region"),
            )
        )
        return per.join(dims, "entity_id").select(
            "entity_id", "sbu", "asset", "region", "amt_contract", "gross_area", "amt_cost", "dt_start", "dt_end",
            "n_orders",
            buckets.size("gross_area", AREA_EDGES).alias("size_category"),
            buckets.amount("amt_contract", AMOUNT_EDGES).alias("contract_bucket"),
        )

    @cached_property
    def project_table(self) -> DataFrame:
        """`project`, written once: what joins it in many profiles doesn't add up all line items again."""
        return self.stored("project", lambda: self.project)

    @cached_property
    def version(self) -> DataFrame:
        """One row per order of a customer: a version effective from the order date."""
        lines = (
            self.table("lineitem", "l_orderkey", "l_shipdate").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("m"))
        )
        return (
            self.table("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(
                F.col("o_custkey").alias("entity_id"),
                F.col("o_orderkey").alias("code"),
                F.to_date("o_orderdate").alias("effective_from"),
                F.to_date("m").alias("target_date"),
                (F.col("o_orderstatus") == "O").alias("is_active"),
            )
        )

    @cached_property
    def task(self) -> DataFrame:
        """One row per line item: a task of a customer, labelled by part type."""
        return (
            self.table(
                "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag",
                "l_linestatus", "l_shipdate",
            )
            .join(self.table("part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("orders", "o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("entity_id"),
                F.col("l_orderkey").alias("code"),
                F.when(F.col("l_tax") > 0, F.col("p_type")).alias("sow"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("task_code"),
                F.to_date("l_shipdate").alias("task_start"),
                F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("task_end"),
                F.col("l_quantity").alias("target"),
                F.when(F.col("l_linestatus") == "F", 0.0)
                .when(F.col("l_returnflag") == "R", F.col("l_quantity") / 2)
                .otherwise(F.col("l_quantity"))
                .alias("remaining"),
                F.when(F.col("l_returnflag") == "A", "early start").otherwise("actual").alias("start_source"),
                F.to_date("o_orderdate").alias("effective_from"),
            )
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """One row per line item: a cost line of a customer, division = brand, cost code = size."""
        x = F.col("l_extendedprice")
        return (
            self.table(
                "lineitem", "l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus", "l_shipdate",
            )
            .join(self.table("part", "p_partkey", "p_brand", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.table("orders", "o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("entity_id"),
                F.col("p_brand").alias("division"),
                F.col("p_size").alias("cost_code"),
                F.lower("p_type").alias("category"),
                F.to_date("l_shipdate").alias("dt_budget"),
                x.alias("amt_original"),
                (x * (1 - F.col("l_discount"))).alias("amt_jtd"),
                (x * F.col("l_tax")).alias("amt_direct"),
                (x * F.col("l_discount")).alias("amt_committed"),
                F.when(F.col("l_returnflag") == "A", x * F.col("l_tax")).otherwise(0.0).alias("pending_in"),
                F.when(F.col("l_returnflag") == "R", -x * F.col("l_discount")).otherwise(0.0).alias("pending_out"),
                (F.col("l_linestatus") == "F").alias("is_current"),
            )
        )

    @cached_property
    def event(self) -> DataFrame:
        return self.table("events", "event_id", "ts", "user_id", "event_type", "value").select(
            "event_id",
            F.col("user_id").alias("entity_id"),
            F.to_date("ts").alias("created"),
            F.col("event_type").alias("trade"),
            F.col("value").alias("days"),
        )

    @cached_property
    def event_project(self) -> DataFrame:
        """Users with the span of their events and the customer's segment."""
        span = self.event.groupBy("entity_id").agg(F.min("created").alias("dt_start"), F.max("created").alias("dt_end"))
        cust = self.table("customer", "c_custkey", "c_mktsegment").select(
            F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("sbu")
        )
        return (
            span.join(cust, "entity_id")
            .withColumn("duration", F.datediff("dt_end", "dt_start"))
            .filter(F.col("duration") > 0)
        )

    @cached_property
    def event_full(self) -> DataFrame:
        return self.event.join(self.event_project, "entity_id")


def bucket_sql(x: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {x} < {e!r} THEN '{n}'" for e, n in zip(edges, labels))
    return f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "entity": ((), """
SELECT o.o_orderkey AS entity_id, o.o_custkey AS cust_id, c.c_mktsegment AS sbu, o.o_orderpriority AS asset,
  n.n_name AS region, o.o_totalprice AS amt_contract, l.gross_area, l.amt_cost, l.n_floors,
  CAST(o.o_orderdate AS DATE) AS dt_start, l.dt_end, o.o_orderstatus AS status
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS gross_area, round(sum(l_extendedprice), 2) AS amt_cost,
   count(*) AS n_floors, CAST(max(l_shipdate) AS DATE) AS dt_end FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey"""),
    "project": ((), f"""
SELECT p.*, {bucket_sql('gross_area', AREA_EDGES, SIZE)} AS size_category,
  {bucket_sql('amt_contract', AMOUNT_EDGES, AMOUNT)} AS contract_bucket
FROM (SELECT o.o_custkey AS entity_id, c.c_mktsegment AS sbu, r.r_name AS asset, n.n_name AS region,
  round(sum(o.o_totalprice), 2) AS amt_contract, sum(l.q) AS gross_area, round(sum(l.x), 2) AS amt_cost,
  CAST(min(o.o_orderdate) AS DATE) AS dt_start, CAST(max(l.m) AS DATE) AS dt_end, count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) q, sum(l_extendedprice) x, max(l_shipdate) m FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2, 3, 4) p"""),
    "version": ((), """
SELECT o.o_custkey AS entity_id, o.o_orderkey AS code, CAST(o.o_orderdate AS DATE) AS effective_from,
  CAST(l.m AS DATE) AS target_date, o.o_orderstatus = 'O' AS is_active
FROM orders o JOIN (SELECT l_orderkey, max(l_shipdate) m FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey"""),
    "task": ((), """
SELECT o_custkey AS entity_id, l_orderkey AS code, CASE WHEN l_tax > 0 THEN p_type END AS sow,
  l_orderkey * 10 + l_linenumber AS task_code, CAST(l_shipdate AS DATE) AS task_start,
  CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS task_end, l_quantity AS target,
  CASE WHEN l_linestatus = 'F' THEN CAST(0 AS DOUBLE) WHEN l_returnflag = 'R' THEN l_quantity / 2 ELSE l_quantity END AS remaining,
  CASE WHEN l_returnflag = 'A' THEN 'early start' ELSE 'actual' END AS start_source,
  CAST(o_orderdate AS DATE) AS effective_from
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""),
    "ledger": ((), """
SELECT o_custkey AS entity_id, p_brand AS division, p_size AS cost_code, lower(p_type) AS category,
  CAST(l_shipdate AS DATE) AS dt_budget, l_extendedprice AS amt_original, l_extendedprice * (1 - l_discount) AS amt_jtd,
  l_extendedprice * l_tax AS amt_direct, l_extendedprice * l_discount AS amt_committed,
  CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_tax ELSE CAST(0 AS DOUBLE) END AS pending_in,
  CASE WHEN l_returnflag = 'R' THEN -l_extendedprice * l_discount ELSE CAST(0 AS DOUBLE) END AS pending_out,
  l_linestatus = 'F' AS is_current
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""),
    "event": ((), """
SELECT event_id, user_id AS entity_id, CAST(ts AS DATE) AS created, event_type AS trade, value AS days FROM events"""),
    "event_project": (("event",), """
SELECT * FROM (SELECT s.entity_id, s.dt_start, s.dt_end, c.c_mktsegment AS sbu, date_diff('day', s.dt_start, s.dt_end) AS duration
FROM (SELECT entity_id, min(created) AS dt_start, max(created) AS dt_end FROM event GROUP BY 1) s
JOIN customer c ON c.c_custkey = s.entity_id) WHERE duration > 0"""),
    "event_full": (("event", "event_project"), """
SELECT e.*, p.dt_start, p.dt_end, p.sbu, p.duration FROM event e JOIN event_project p USING (entity_id)"""),
}


def with_(*names: str, body: str, extra: str = "") -> str:
    """`WITH` the named views (and what they need), an optional extra CTE list, then the body."""
    order: list[str] = []

    def need(n: str) -> None:
        for d in CTES[n][0]:
            need(d)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    if extra:
        parts.append(extra.strip())
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def qd(x: str, p: float, name: str, flt: str = "") -> str:
    return f"quantile_disc({x}, {p}){flt} AS {name}"
