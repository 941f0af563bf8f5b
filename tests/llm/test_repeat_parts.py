"""Groups of suffixes that are summed up by parts of blocks give the same rows as a plain version."""

import random

import pytest
from pyspark.sql import functions as F
from test_words import order, plain_repeats, repeat_rows

from sigloom.llm import repeats


def shared_rows():
    """One prefix in every document, with one continuation in most and many in some; repeats inside one block and across blocks."""
    r = random.Random(8)
    draw = lambda n: [r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(n)]
    common, longer = draw(9), draw(20)
    rows = [(i, " ".join(draw(r.randrange(6)) + common + (longer if i % 3 else draw(12)) + draw(r.randrange(6)))) for i in range(90)]
    return rows + [(1, rows[30][1]), (None, rows[3][1]), (200, rows[6][1] + " " + rows[6][1])]


@pytest.mark.parametrize("fan", [1, 3])
@pytest.mark.parametrize("rows", [shared_rows(), repeat_rows()], ids=["shared", "repeated"])
def test_parts_of_blocks(table, rows, fan):
    got = repeats.remove_repeats(table(rows, "doc_id long, text string", "part", "rest"), block_bytes=1000, fan=fan).collect()
    assert order((x.doc_id, x.n_words, x.n_removed, x.kept) for x in got) == plain_repeats(rows)


@pytest.mark.parametrize("fan", [100, 2])
def test_over_blocks(table, fan):
    rows = [(b, p, None if p == 3 and b == 4 else 10 * p + (p == 2) * (b % 2), 100 - b) for p in (1, 2, 3) for b in range(7)] + [(2, 9, 90, 5)]
    got = repeats.over_blocks(table(rows, repeats.FOUND).withColumn("block", F.col("block").cast("int")), ["prefix"], 7, fan).collect()
    assert sorted((x.prefix, x.block, x.least, x.branches) for x in got) == [(p, b, 94, p > 1) for p in (1, 2, 3) for b in range(7)]
