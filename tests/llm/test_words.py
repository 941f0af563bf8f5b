"""Word spans and the operators on words against plain versions in Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sigloom.llm import contamination, repeats, shingle_join, spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def order(rows):
    return sorted(rows, key=str)


def test_words_hashes_and_joins():
    texts = ["Hello  wörld a", "", None, "b c", "ab", "cd  ab ", "a\tb\nHello x" * 3, "x" * 10]
    data, at = spans.column_bytes(pa.array(texts))
    found = spans.words(data, at, spans.NOT_SPACE)
    expected = [PLAIN.findall(t or "") for t in texts]
    flat = [w for ws in expected for w in ws]
    assert [bytes(data[a:b]).decode() for a, b in zip(found.start, found.end)] == flat
    assert list(np.diff(found.first)) == [len(ws) for ws in expected]
    by_word = {}
    for w, h in zip(flat, spans.hashes(data, found)):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    joined, to = spans.join_words(data, found, np.arange(len(flat)) % 3 != 0)
    kept = iter(range(len(flat)))
    for r, ws in enumerate(expected):
        assert bytes(joined[to[r] : to[r + 1]]).decode() == " ".join(w for w in ws if next(kept) % 3 != 0)


def plain_repeats(rows, size=13):
    words = [PLAIN.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            first[x] = min(first.get(x, LAST), LAST if d is None else d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (LAST if d is None else d):
                gone.update(range(k, k + size))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return order(out)


def repeat_rows():
    r = random.Random(1)
    base = [" ".join(r.choice("abc") for _ in range(r.choice([5, 14, 40, 80]))) for _ in range(30)]
    rows = []
    for _ in range(120):
        a, b = r.choice(base).split(), r.choice(base).split()
        rows.append((r.randrange(100), " ".join(a[r.randrange(5) :] + b[: r.randrange(30)])))
    return rows + [(None, base[0]), (None, None), (7, ""), (3, None), (500, "  \n "), (501, base[3]), (502, base[3]), (502, base[3]), (503, "ä " * 3000)]


@pytest.mark.parametrize("rows, block", [(repeat_rows(), 300), (repeat_rows(), 1 << 20), ([], 1 << 20)])
def test_repeats(table, rows, block):
    docs = table(rows, "doc_id long, text string", "block", "kept", "carried", "n_words")
    got = repeats.remove_repeats(docs, block_bytes=block).collect()
    assert order((x.doc_id, x.n_words, x.n_removed, x.kept) for x in got) == plain_repeats(rows)
    for x in got:
        assert sum(g["last"] - g["first"] + 1 for g in x.removed) == x.n_removed and x.carried["kept"] == "clash"


def plain_links(rows):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for w in (lowered(t) for _, t in rows)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = collections.defaultdict(lambda: LAST)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least[top(i)], d)
    return order((d, None if d is None else least[top(i)], links[i], len(sets[i])) for i, (d, _) in enumerate(rows))


def link_rows():
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.choice([3, 8, 60, 200]))] for _ in range(12)]
    rows = []
    for i in range(160):
        text = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text)))
    return rows + [(None, rows[0][1]), (900, None), (901, ""), (902, "!! .."), (903, rows[0][1].upper()), (904, rows[0][1]), (904, rows[0][1]), (905, "long word " * 5000)]


@pytest.mark.parametrize("texts_a_part", [1024, 16])
def test_links(table, monkeypatch, texts_a_part):
    monkeypatch.setattr(shingle_join, "PART_TEXTS", texts_a_part)
    rows = link_rows()
    got = shingle_join.links(table(rows, "doc_id long, text string", "rep", "nodes", "set_a")).collect()
    assert order(tuple(x) for x in got) == plain_links(rows)


def test_no_documents_to_link(table):
    assert shingle_join.links(table([], "doc_id long, text string")).collect() == []


def test_prefixes_are_shortened_to_the_recall():
    for recall in (0.5, 0.9, 0.9995):
        n = shingle_join.prefix_length(0.8, recall)
        found = lambda k: 1 - (1 - 0.8**k) ** shingle_join.TREES
        assert found(n) >= recall and (n == shingle_join.LONGEST or found(n + 1) < recall)


def plain_leaks(docs, items):
    out = []
    for d, t in docs:
        w = lowered(t)
        for i, text in items:
            x = lowered(text)
            if i is None or not x:
                continue
            n = min(5, len(x))
            own = collections.Counter(tuple(x[k : k + n]) for k in range(len(x) - n + 1))
            best, count = None, 0
            for s in range(len(w) - len(x) + 1):
                there = collections.Counter(tuple(w[k : k + n]) for k in range(s, s + len(x) - n + 1))
                least = sum((own & there).values())
                score = least / (2 * sum(own.values()) - least)
                if score >= 0.8 - 1e-12:
                    count += 1
                    if best is None or score > best[1]:
                        best = s, score
            if best:
                out.append((d, i, count, best[0], len(x), round(best[1], 9)))
    return order(out)


@pytest.mark.parametrize("block", [20_000, 7])
def test_leaks(table, monkeypatch, block):
    monkeypatch.setattr(contamination, "ITEM_BLOCK", block)
    monkeypatch.setattr(contamination, "LOOKED_UP", block)
    r = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([2, 4, 15, 30, 59])))) for i in range(20)]
    items += [(None, "a b"), (77, None), (78, ""), (79, "w1 " * 8), (79, "w2 w3 w4 w5 w6")]
    docs = []
    for i in range(80):
        x, it = [r.choice(words) for _ in range(r.randrange(60))], (r.choice(items)[1] or "").split()
        for _ in range(r.choice([0, 1, 2])):
            if it:
                it[r.randrange(len(it))] = r.choice(words)
        docs.append((i, " ".join(x + [y.upper() + "," for y in it] + x[:5])))
    docs += [(None, items[3][1]), (5, None), (6, ""), (7, "w1 " * 40)]
    got = contamination.leaks(table(docs, "doc_id long, text string", "item_id", "similarity"), table(items, "item_id long, text string", "doc_id")).collect()
    assert order((x.doc_id, x.item_id, x.n_windows, x.first_word, x.n_words, round(x.similarity, 9)) for x in got) == plain_leaks(docs, items)
    assert all(x.hamming <= contamination.RADIUS for x in got)


def test_no_items_or_documents(table):
    some = table([(1, "a b c d e f")], "doc_id long, text string")
    item = table([(1, "a b c d e f")], "item_id long, text string")
    assert contamination.leaks(some.limit(0), item).collect() == [] and contamination.leaks(some, item.limit(0)).collect() == []


def test_every_fingerprint_within_the_radius_is_looked_up():
    r = random.Random(2)
    for _ in range(200):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), contamination.RADIUS):
            b ^= 1 << bit
        pair = contamination.block_values(np.array([a, b], np.uint64))
        assert any(v[0] ^ v[1] in contamination.flipped(w) for v, w in zip(pair, contamination.WIDTHS))
