"""Benchmark items in documents that are shorter than the item, against a plain version."""

import collections
import random

import pytest

from sigloom.llm import contamination
from test_words import lowered, order


def plain(docs, items):
    """Windows of an item's length, or the whole of a shorter document."""
    out = []
    for d, t in docs:
        w = lowered(t)
        for i, text in items:
            x = lowered(text)
            if i is None or not x or not w:
                continue
            n, size = min(5, len(x)), min(len(x), len(w))
            count = lambda v: collections.Counter(tuple(v[k : k + n]) for k in range(len(v) - n + 1))
            own, found = count(x), []
            for s in range(len(w) - size + 1):
                there = count(w[s : s + size])
                least = sum((own & there).values())
                score = least / (sum(own.values()) + sum(there.values()) - least)
                if score >= 0.8 - 1e-12:
                    found.append((-score, s))
            if found:
                out.append((d, i, len(found), min(found)[1], size, round(-min(found)[0], 9)))
    return order(out)


@pytest.mark.parametrize("block", [20_000, 7])
def test_documents_shorter_than_an_item(table, monkeypatch, block):
    monkeypatch.setattr(contamination, "ITEM_BLOCK", block)
    r = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([2, 4, 5, 8, 9, 20, 38, 59])))) for i in range(40)]
    items += [(50, "w1 " * 20), (51, items[6][1] + " w1"), (52, items[7][1])]
    docs = [(1000, "w1 " * 17), (1001, "w1"), (1002, "")]
    for i, text in items:
        x = text.split()
        for less in range(1, 7):
            docs.append((10 * i + less, " ".join(x[: len(x) - less])))
        docs.append((10 * i + 8, " ".join(x[: len(x) // 2] + x[len(x) // 2 + 1 :])))
        docs.append((10 * i + 9, " ".join(x + ["other"])))
    got = contamination.leaks(table(docs, "doc_id long, text string"), table(items, "item_id long, text string")).collect()
    expected = plain(docs, items)
    assert order((x.doc_id, x.item_id, x.n_windows, x.first_word, x.n_words, round(x.similarity, 9)) for x in got) == expected
    shorter = {i: len(lowered(t)) for i, t in items}
    assert sum(x.n_words < shorter[x.item_id] for x in got) > 50
