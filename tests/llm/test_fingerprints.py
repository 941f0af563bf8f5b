"""The search of fingerprints against all pairs, and counts of shared shingles against counters."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from sigloom.llm import contamination


def items_of(texts):
    made, _, _ = contamination.prepare(list(range(len(texts))), texts)
    return made


@pytest.mark.parametrize("looked_up", [1 << 22, 50])
def test_pairs_within_the_radius(monkeypatch, looked_up):
    monkeypatch.setattr(contamination, "LOOKED_UP", looked_up)
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = items_of([" ".join(r.choice(words) for _ in range(12)) for _ in range(150)] + ["w1 " * 12] * 3)[12]
    near = [int(x) ^ sum(1 << b for b in r.sample(range(64), k)) for x in items.prints[::10] for k in (0, 3, 19, 23, 24)]
    prints = np.array(near + [r.getrandbits(64) for _ in range(50)], np.uint64)
    w, k = contamination.within(prints, items.prints)
    plain = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(items.prints) if (int(a) ^ int(b)).bit_count() <= contamination.RADIUS]
    assert list(zip(w.tolist(), k.tolist(), strict=True)) == plain and len(plain) > 45
    assert [len(x) for x in (*contamination.within(prints[:0], items.prints), *contamination.within(prints, prints[:0]))] == [0] * 4


@pytest.mark.parametrize("looked_up", [1 << 22, 7])
def test_shingles_in_common(monkeypatch, looked_up):
    monkeypatch.setattr(contamination, "LOOKED_UP", looked_up)
    r = random.Random(5)
    draw = lambda n: [r.choice("abc") for _ in range(n)]
    texts, own = [" ".join(draw(9)) for _ in range(20)], draw(60)
    items = items_of(texts)[9]
    _, h = contamination.read_words(pa.array([" ".join(own)]))
    at, k = np.repeat(np.arange(0, 52, 4), 20), np.tile(np.arange(20), 13)
    got = contamination.in_common(items, contamination.spans.grams(h, 5), 5, at, k)
    bags = lambda x: collections.Counter(tuple(x[i : i + 5]) for i in range(5))
    assert got.tolist() == [sum((bags(own[a : a + 9]) & bags(texts[j].split())).values()) for a, j in zip(at, k, strict=True)]
