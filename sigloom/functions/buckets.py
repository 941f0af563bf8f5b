"""Bands of a number. Every band list lives in `values`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom.functions import values
from sigloom.functions.clean import col


def left_closed(x, edges: Sequence[float], labels: Sequence[str], null_to_last: bool = False) -> Column:
    """`[edge, next edge)`; NULL stays NULL unless asked to fall into the last band."""
    v = col(x)
    out = F.when(v.isNull(), labels[-1] if null_to_last else None)
    for edge, name in zip(edges, labels):
        out = out.when(v < edge, name)
    return out.otherwise(labels[-1])


def right_closed(x, edges: Sequence[float], labels: Sequence[str], low: float = 0.0) -> Column:
    """`(previous edge, edge]`; NULL at or below the lower limit."""
    v = col(x)
    out = F.when(v.isNull() | (v <= low), None)
    for edge, name in zip(edges, labels):
        out = out.when(v <= edge, name)
    return out.otherwise(labels[-1])


def size(x, edges=values.SIZE_EDGES, **kw) -> Column:
    return left_closed(x, edges, values.SIZE_LABELS, **kw)


def amount(x, edges=values.AMOUNT_EDGES, **kw) -> Column:
    return left_closed(x, edges, values.AMOUNT_LABELS, **kw)


def severity(days) -> Column:
    return left_closed(days, values.SEVERITY_EDGES, values.SEVERITY_LABELS)


def progress(x) -> Column:
    return left_closed(x, values.PROGRESS_EDGES, values.PROGRESS_LABELS)


def position(x, bands: int = 5) -> Column:
    edges, labels = {
        5: (values.POSITION5_EDGES, values.POSITION5_LABELS),
        4: (values.POSITION4_EDGES, values.POSITION4_LABELS),
        3: (values.POSITION3_EDGES, values.POSITION3_LABELS),
    }[bands]
    return left_closed(x, edges, labels)


def completion(pct) -> Column:
    return left_closed(pct, values.COMPLETION_EDGES, values.COMPLETION_LABELS)


def completion_status(remaining, target) -> Column:
    r, t = col(remaining), col(target)
    return (
        F.when(r == 0, "completed")
        .when(r == t, "not_started")
        .when((r > 0) & (r < t), "active")
        .otherwise("unknown")
    )


def decile(x) -> Column:
    return F.floor(col(x) * 10).cast("double") / 10


def spi_state(spi) -> Column:
    v = col(spi)
    out = F.when(v.isNull(), None)
    for i, edge in enumerate(values.SPI_EDGES):
        out = out.when(v < edge, i)
    return out.otherwise(len(values.SPI_EDGES))


def zone(x, low, high, labels: Sequence[str] = ("pre_sow", "during_sow", "post_sow")) -> Column:
    """Below the low cut-off, between, above the high one."""
    v = col(x)
    return F.when(v < col(low), labels[0]).when(v > col(high), labels[2]).otherwise(labels[1])
