"""Window functions over a long ordered chain of one key.

A window partitioned by an entity puts the whole entity in one task. That is the plan where the input's tables are small; it
spills, so the size it starts from is no limit. Else the input is computed once, written to the shared folder, and its rows are cut
into slices of like size by borders in the order of (keys, order): sampled rows, compared by all columns, so slices are even
however the values are spread and however many rows share a key or the first order column. Where no two borders lie in one key,
every key is short (three slices of one would show two) and a plain window over the written rows deals them evenly. Else the window runs inside each
slice, after one exchange by slice. Only the first and the last key of a slice can reach over a border: one row for each of them is
aggregated in the same pass, carried along the slices and joined back by slice number, with which the rows are already partitioned.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.session import ensure_checkpoint_dir

ROWS_PER_SLICE = 2_000_000
#: slices are longer than asked for beyond this number of them; it bounds the borders that travel with the plan
MOST_SLICES = 10_000
#: sampled rows for each slice
SAMPLES = 32
#: bytes of the tables below a plan up to which a plain window is used
PLAIN_BYTES = 128 << 20
_SLICE, _BORDERS, _AT = "__ow_slice", "__ow_borders", "__ow_at"


def one_key(column: str) -> Column:
    """The key 0 for every row. A literal would fold away and leave a join without a key."""
    return F.pmod(F.hash(column), F.lit(1))


def bytes_below(df: DataFrame) -> int:
    """Estimated size of the tables that a plan reads, without running it."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by the keys to as many partitions as the session shuffles to, and one more.

    The adaptive planner joins partitions by their bytes; rows that are few and small but become many, or cost much, would end in a
    few tasks. A number that is named stays, and what follows by these keys is not dealt anew. With the session's own number the
    planner would leave the step out where the rows lie by these keys already, in partitions that it may join.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, *keys)


def borders(df: DataFrame, columns: Sequence[str], rows_per_slice: int) -> tuple[Column, int] | None:
    """The rows, as structs of the columns, at which slices begin, ascending, and their number; None where one slice is enough.

    Of a sample of `SAMPLES` rows a slice every `SAMPLES`-th is a border, so sample and borders are bounded by `MOST_SLICES`.
    """
    rows = df.count()
    slices = min(MOST_SLICES, -(-rows // rows_per_slice))
    if slices < 2:
        return None
    at = F.struct(*columns)
    sample = df.select(at.alias(_AT)).sample(min(1.0, SAMPLES * slices / rows), seed=7)
    every = F.filter(F.sort_array(F.collect_list(_AT)), lambda _, i: i % SAMPLES == SAMPLES - 1)
    made = sample.agg(every.alias("b"))
    kind = made.schema["b"].dataType
    found = made.select(F.to_json("b").alias("json"), F.size("b").alias("n")).first()
    # one text literal; where the round trip changes a value all rows are compared with the changed one
    return F.sort_array(F.from_json(F.lit(found["json"]), kind)), found["n"]


def holds_two(df: DataFrame, borders: Column, keys: Sequence[str]) -> bool:
    """Whether two borders that follow each other lie in one key."""
    def again(x: Column, i: Column) -> Column:
        same = i > 0
        for k in keys:
            same = same & x[k].eqNullSafe(F.get(borders, i - 1)[k])
        return same

    return df.sparkSession.range(1).select(F.exists(F.transform(borders, again), lambda x: x).alias("two")).first()["two"]


def slice_of(borders: Column, n: int, columns: Sequence[str]) -> Column:
    """The number of borders up to the row, by binary search."""
    steps = [1 << b for b in reversed(range(max(1, n.bit_length())))]

    def search(at: Column) -> Column:
        def step(passed: Column, by: Column) -> Column:
            reached = passed + by
            return F.when((reached <= n) & (F.get(borders, reached - 1) <= at), reached).otherwise(passed)

        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

    # the row's struct is made once, not in each step
    return F.get(F.transform(F.array(F.struct(*columns)), search), 0)


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    row_number: str | None = None,
    count: str | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    running_max: Mapping[str, str] | None = None,
    last_value: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Window columns per key in ascending order; maps are output name -> input column.

    `running_*` include the current row, `last_value` is the latest non-NULL up to it,
    `count` is the size of the key, `total` the sum of a column over it. The order should be unique within a key; rows
    that are equal in all order columns share a slice. With `rows_per_slice` the input is sliced whatever its size.
    """
    wanted = _Wanted(list(keys), list(order), row_number, count, dict(lag or {}), dict(lead or {}), dict(running_sum or {}), dict(running_max or {}), dict(last_value or {}), dict(total or {}))
    if rows_per_slice is None and bytes_below(df) <= PLAIN_BYTES:
        return df.withColumns(wanted.plain([]))
    base = written(df)
    columns = list(dict.fromkeys([*keys, *order]))
    found = borders(base, columns, rows_per_slice or ROWS_PER_SLICE)
    if found is None:
        return base.withColumns(wanted.plain([]))
    if rows_per_slice is None and not holds_two(base, found[0], keys):
        if found[1] >= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):  # tasks as long as a slice
            base = base.repartition(found[1] + 1, *keys)
        return base.withColumns(wanted.plain([]))
    return wanted.sliced(base, *found, columns)


class _Wanted:
    """The window columns of one call, inside a slice and across borders."""

    def __init__(self, keys, order, row_number, count, lag, lead, running_sum, running_max, last_value, total):
        self.keys, self.order = keys, order
        self.row_number, self.count = row_number, count
        self.lag, self.lead = lag, lead
        self.running_sum, self.running_max, self.last_value, self.total = running_sum, running_max, last_value, total

    def plain(self, more: Sequence[str], mark: str = "") -> dict[str, Column]:
        """Output name -> window over the rows of a key and the columns `more`."""
        whole = W.partitionBy(*self.keys, *more)
        w = whole.orderBy(*self.order)
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        out: dict[str, Column] = {}
        if self.row_number or mark:
            out[mark or self.row_number] = F.row_number().over(w)
        if self.count:
            out[mark + self.count] = F.count(F.lit(1)).over(whole)
        out |= {mark + o: F.sum(c).over(whole) for o, c in self.total.items()}
        out |= {mark + o: F.lag(c).over(w) for o, c in self.lag.items()}
        out |= {mark + o: F.lead(c).over(w) for o, c in self.lead.items()}
        out |= {mark + o: F.sum(c).over(upto) for o, c in self.running_sum.items()}
        out |= {mark + o: F.max(c).over(upto) for o, c in self.running_max.items()}
        out |= {mark + o: F.last(c, ignorenulls=True).over(upto) for o, c in self.last_value.items()}
        return out

    def sliced(self, base: DataFrame, borders: Column, n: int, columns: Sequence[str]) -> DataFrame:
        cut = base.withColumn(_SLICE, slice_of(borders, n, columns))
        here = cut.repartition(n + 1, _SLICE)
        local = self.plain([_SLICE], "__l_")
        if self.lead:
            local["__last"] = F.lead(F.lit(1)).over(W.partitionBy(*self.keys, _SLICE).orderBy(*self.order)).isNull()
        # a slice without a key across its borders has no carry; the join is on the number by which the rows are dealt
        joined = here.withColumns(local).join(self.carry(cut, borders), _SLICE, "left")
        same = F.filter("__carry", lambda c: self._same(c))
        joined = joined.withColumn("__c", F.get(same, 0))
        return joined.select(*base.columns, *[v.alias(o) for o, v in self._merged().items()])

    def _same(self, other: Column) -> Column:
        out = F.lit(True)
        for k in self.keys:
            out = out & F.col(k).eqNullSafe(other[k])
        return out

    def carry(self, cut: DataFrame, borders: Column) -> DataFrame:
        """For each slice the keys that reach over its borders, two at most, with what other slices hold of them."""
        at = F.struct(*self.order)
        across = self._same(F.get(borders, F.col(_SLICE))) | self._same(F.get(borders, F.col(_SLICE) - 1))
        aggs = [F.count(F.lit(1)).alias("__n")]
        aggs += [F.max_by(F.struct(c), at).alias(f"__a_{o}") for o, c in self.lag.items()]
        aggs += [F.min_by(F.struct(c), at).alias(f"__a_{o}") for o, c in self.lead.items()]
        aggs += [F.sum(c).alias(f"__a_{o}") for o, c in (self.running_sum | self.total).items()]
        aggs += [F.max(c).alias(f"__a_{o}") for o, c in self.running_max.items()]
        aggs += [F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"__a_{o}") for o, c in self.last_value.items()]
        parts = cut.filter(across).groupBy(_SLICE, *self.keys).agg(*aggs)
        whole = W.partitionBy(*self.keys)
        along = whole.orderBy(_SLICE)
        before = along.rowsBetween(W.unboundedPreceding, -1)
        made = {"rows_before": F.sum("__n").over(before), "rows": F.sum("__n").over(whole)}
        made |= {f"v_{o}": F.lag(f"__a_{o}").over(along) for o in self.lag}
        made |= {f"v_{o}": F.lead(f"__a_{o}").over(along) for o in self.lead}
        made |= {f"v_{o}": F.sum(f"__a_{o}").over(before) for o in self.running_sum}
        made |= {f"v_{o}": F.sum(f"__a_{o}").over(whole) for o in self.total}
        made |= {f"v_{o}": F.max(f"__a_{o}").over(before) for o in self.running_max}
        made |= {f"v_{o}": F.last(f"__a_{o}", ignorenulls=True).over(before) for o in self.last_value}
        row = F.struct(*self.keys, *[v.alias(o) for o, v in made.items()])
        return parts.select(_SLICE, row.alias("__row")).groupBy(_SLICE).agg(F.collect_list("__row").alias("__carry"))

    def _merged(self) -> dict[str, Column]:
        """Output name -> column of a row with its slice's window (`__l_`) and its key's carry (`__c`)."""
        here, other = (lambda o: F.col(f"__l_{o}")), (lambda o: F.col("__c")[f"v_{o}"])
        out: dict[str, Column] = {}
        if self.row_number:
            out[self.row_number] = (F.col("__l_") + F.coalesce(F.col("__c")["rows_before"], F.lit(0))).cast("int")
        if self.count:
            out[self.count] = F.coalesce(F.col("__c")["rows"], here(self.count))
        out |= {o: F.coalesce(other(o), here(o)) for o in self.total}
        out |= {o: F.when(F.col("__l_") == 1, other(o)[c]).otherwise(here(o)) for o, c in self.lag.items()}
        out |= {o: F.when(F.col("__last"), other(o)[c]).otherwise(here(o)) for o, c in self.lead.items()}
        out |= {o: F.coalesce(here(o) + other(o), here(o), other(o)) for o in self.running_sum}
        out |= {o: F.greatest(here(o), other(o)) for o in self.running_max}
        out |= {o: F.coalesce(here(o), other(o)) for o in self.last_value}
        return out
