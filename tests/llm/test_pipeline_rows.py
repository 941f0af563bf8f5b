"""Whole rows of the pipeline's stages on a small fixture, against what plain Python says must be left."""

import random

import corpus_pipeline as cp
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared, item = sentence("shared", 30), sentence("item", 40)
    near = sentence(1, 120).split()
    near[60] = "changed"
    return {
        "own": sentence(1, 120), "near": " ".join(near), "other": sentence(2, 90), "item": item, "leak": f"{sentence(3, 50)} {item} {sentence(4, 50)}",
        "first": f"{sentence(5, 40)} {shared} {sentence(6, 40)}", "second": f"{sentence(7, 50)}  {shared}\n{sentence(8, 50)}", "short": "a few words",
    }


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, texts["item"]), (2, sentence("unseen", 30)), (3, None)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def rows(texts, *which):
    return [(i, texts.get(t, t), "en", f"s{i}", len(texts.get(t, t) or "")) for i, t in which]


def run(spark, stage, given, folder):
    return sorted((tuple(r) for r in stage(spark, spark.createDataFrame(given, SCHEMA).repartition(3), folder).collect()), key=str)


def test_one_document_of_each_class_stays(spark, texts, folder):
    given = rows(texts, (5, "own"), (3, "own"), (9, "near"), (4, "other"), (6, "short"), (7, ""), (8, None), (2, "short"), (None, "own"), (11, "leak"))
    kept = {3, 4, 2, 11}
    got = run(spark, cp.near_duplicate_filter, given, folder)
    assert {r[0] for r in got} >= kept and not {r[0] for r in got} & {5, 6, 9}
    assert all(r in given for r in got) and [r for r in got if r[0] is None] == [r for r in given if r[0] is None]
    # texts without a word are no one's copies
    assert {7, 8} <= {r[0] for r in got}


def test_rows_of_one_id_become_one(spark, texts, folder):
    given = rows(texts, (1, "own"), (1, "other"), (2, "leak"), (2, "leak"))
    got = run(spark, cp.near_duplicate_filter, given, folder)
    assert sorted(r[0] for r in got) == [1, 2] and all(r in given for r in got)
    one = next(r for r in got if r[0] == 1)
    assert one == min(r for r in given if r[0] == 1)


def without_repeats(given, n=13):
    """Words covered by a window that a smaller id also has go; a text that keeps all its words stays as it is."""
    words = [(i, (t or "").split()) for i, t, *_ in given]
    least = {}
    for i, w in words:
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, w), row in zip(words, given, strict=True):
        gone = {j for k in range(len(w) - n + 1) if least[tuple(w[k : k + n])] < i for j in range(k, k + n)}
        if not gone:
            out.append(row)
            continue
        text = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, text, *row[2:4], len(text)))
    return sorted(out, key=str)


def test_repeats_go_and_lengths_follow(spark, texts, folder):
    given = rows(texts, (1, "first"), (2, "second"), (3, "own"), (4, "own"), (5, "short"), (6, ""), (7, None), (8, "first"), (9, "other"))
    got = run(spark, cp.repeat_removal, given, folder)
    assert got == without_repeats(given)
    by_id = {r[0]: r for r in got}
    assert by_id[4][1] == "" and by_id[4][4] == 0 and by_id[2][1] != texts["second"] and by_id[1] == given[0]


def test_documents_with_items_go_and_clean_ones_stay(spark, texts, folder):
    given = rows(texts, (1, "leak"), (2, "own"), (3, "item"), (4, "short"), (5, ""), (6, None), (7, "second"), (None, "own"))
    got = run(spark, cp.decontamination, given, folder)
    assert got == sorted((r for r in given if r[0] not in (1, 3)), key=str)


def test_packing_holds_every_document_once(spark, texts, folder):
    given = rows(texts, (1, "leak"), (2, "own"), (3, "short"), (4, None))
    got = cp.sequence_packing(spark, spark.createDataFrame(given, SCHEMA), folder).collect()
    for i, text, *_ in given:
        pieces = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        ids = b"".join(r["ids"] for r in pieces)
        want = cp.packing.encoder(cp.packing.tokenizer_path(), False).bytes(text or "") + (1).to_bytes(4, "little")
        assert ids == want and all(r["doc_tokens"] == len(want) // 4 for r in pieces)
