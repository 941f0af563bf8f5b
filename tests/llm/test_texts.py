"""Operators on single texts, vectors and pages; the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sigloom.llm import language, licenses, main_text, neighbours, packing, quality, queries, token_counts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["  a  b\n\n c\t d  ", "x's  we'll   z", "<|endoftext|> hi", "日本 語 ١٢٣ a1b2  q", "", " ", "a ", " a", "a \nb", "a\n b", "\x1c a\x1c b", "x" * 5000]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(packing.tokenizer_path())
    made.encode_special_tokens = True
    return lambda text: made.encode(text, add_special_tokens=False).ids


def plain_scan(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(table):
    texts = [None, "", "MIT License", "the MIT, license: mit-license cc BY", "gnu general public license apache license", "mit mit license mitlicense", "é mit license", "cc bycc by cc by", "word " * 20000 + "Apache\nLicense"]
    texts += ["SPDX-License-Identifier: MIT OR (GPL-2.0-only WITH Classpath-exception-2.0 AND Apache-2.0)", "SPDX-License-Identifier: (MIT", "released into the public domain"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "mit license"), (2, "MIT License")]
    got = licenses.scan(table(rows, "doc_id long, text string", "labels", "score")).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got), key=lambda r: str(r)) == sorted(((d, *plain_scan(t)) for d, t in rows), key=lambda r: str(r))
    by_id = {x.doc_id: x for x in got}
    assert by_id[9].labels == "mit" and by_id[9].score == 1 and by_id[10].expressions == [] and by_id[11].labels == "public-domain"
    assert all(0 <= x.score <= 1 for x in got) and key
    assert licenses.scan(table([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text, families", [("MIT", {"mit"}), ("MIT AND GPL-3.0+", {"mit", "gpl"}), ("GPL-2.0 OR Apache-2.0 AND MIT", {"apache", "mit"}), ("(LGPL-2.1 OR MIT) AND BSD-3-Clause", {"mit", "bsd"}), ("GPL-2.0 with X or AGPL-3.0", {"gpl"}), ("MIT -->", {"mit"})])
def test_expressions(text, families):
    assert licenses.evaluate(licenses.postfix(text))[0] == families


@pytest.mark.parametrize("text", ["", "AND MIT", "MIT OR", "(MIT", "MIT)", "MIT (", "()"])
def test_broken_expressions(text):
    assert licenses.postfix(text) is None


def test_language(table, spark):
    r = random.Random(1)
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "er", "ein"], "cc": ["que", "ión", "os", "ra"]}
    make = lambda lang: " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randrange(2, 5))) for _ in range(60))
    train = [(i, make(lang), lang) for i, lang in enumerate(sorted(syllables) * 20)] + [(None, "x", None), (900, None, "aa"), (901, "", "bb")]
    made = language.learn(table(train, "doc_id long, text string, lang string"))
    assert set(made) == set(syllables)
    rows = [(i, make(lang) * (200 if i == 3 else 1), lang) for i, lang in enumerate(sorted(syllables) * 10)]
    odd = [(100, None, None), (101, "", None), (102, "12 !?", None), (None, rows[0][1], "aa"), (0, rows[0][1], "aa")]
    got = language.identify(table([x[:2] for x in rows + odd], "doc_id long, text string", "lang_pred", "score"), made).collect()
    expected = {d: lang for d, _, lang in rows}
    for x in got:
        assert 0 <= x.score <= 1 and x.lang_pred == ("und" if x.doc_id in (100, 101, 102) else expected.get(x.doc_id, "aa"))
    assert language.learn(table([], "doc_id long, text string, lang string")) == {}
    assert {x.lang_pred for x in language.identify(table([(1, "a b")], "doc_id long, text string"), {}).collect()} == {"und"}


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op2_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.96


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").select("doc_id", "score", "quality").collect()
    assert all(zlib.crc32(str(x.doc_id).encode()) % 5 == 0 for x in got)
    good, bad = [x.score for x in got if x.quality == 1], [x.score for x in got if x.quality == 0]
    assert np.mean([[(a > b) + 0.5 * (a == b) for b in bad] for a in good]) > 0.95


def test_quality_scores(table):
    r = np.random.default_rng(0)
    chunks = r.integers(97, 123, (40, quality.HOP + quality.OVERLAP), dtype=np.uint8)
    model = quality.fit(chunks, np.arange(40), np.arange(40) % 2, steps=3)
    text = "".join(map(chr, r.integers(97, 123, 5000)))
    rows = [(1, text), (2, None), (3, ""), (4, "a"), (5, "é" * 448), (None, text), (1, text), (6, text + "tail" * 300)]
    got = quality.score(table(rows, "doc_id long, text string", "score", "carried"), model).collect()
    for x, (_, t) in zip(got, rows):
        b, logits = (t or "").encode(), []
        for i in range(max(1, -(-(len(b) + quality.WIDTH) // quality.HOP))):
            at = i * quality.HOP
            starts = [p for p in range(at, min(at + quality.HOP + quality.OVERLAP, len(b)), quality.STRIDE)]
            if at + quality.HOP >= max(1, -(-(len(b) + quality.WIDTH) // quality.HOP)) * quality.HOP:
                starts = [p for p in starts if p < at + quality.HOP]
            pad = b + bytes(quality.WIDTH)
            act = [sum(model.embedding[pad[p + k]] @ model.filters[k * quality.DIMENSIONS : (k + 1) * quality.DIMENSIONS] for k in range(quality.WIDTH)) for p in starts]
            top = np.maximum(np.max(act, axis=0) + model.bias, 0) if act else np.zeros(quality.FILTERS)
            hop = np.zeros((1, quality.HOP), np.uint8)
            own = b[at : at + quality.HOP]
            hop[0, : len(own)] = np.frombuffer(own, np.uint8)
            logits.append(np.append(top, quality.repeated(hop, np.array([len(own)]))) @ model.weight + model.offset[0])
        assert math.isclose(x.score, 1 / (1 + math.exp(-np.mean(logits))), rel_tol=1e-3, abs_tol=1e-4)
    empty = quality.train(table([], "doc_id long, text string, label int"))
    assert {x.score for x in quality.score(table([(1, "a")], "doc_id long, text string"), empty).collect()} == {0.5}


def test_packing_is_an_exact_round_trip(table, tokenizer):
    r = random.Random(4)
    texts = [*ODD, None, *(" ".join(r.choice(["foo", "Bar,", "ü", "12"]) for _ in range(r.choice([3, 50, 700, 6000]))) for _ in range(40))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id")]
    got = packing.pack(table(rows, "doc_id long, text string", "start", "ids"), capacity=256, piece=64, block=8).collect()
    by_doc, by_sequence = {}, {}
    for x in got:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_sequence.setdefault(x.sequence_id, []).append(x)
    for d, t in rows:
        expected = [*tokenizer(t or ""), 1]
        pieces = sorted(by_doc[d], key=lambda x: x.start)
        assert [i for x in pieces for i in np.frombuffer(x.ids, np.uint32)] == expected
        assert [x.start for x in pieces] == list(np.cumsum([0, *(x.length for x in pieces[:-1])])) and {x.doc_tokens for x in pieces} == {len(expected)}
    total = 0
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 256
        total += at
    assert total / (256 * len(by_sequence)) > 0.85
    assert packing.pack(table([], "doc_id long, text string")).count() == 0


def test_differencing_beats_dealing_out():
    r = random.Random(3)
    sizes = [r.randrange(1, 500) for _ in range(300)]
    groups = packing.difference(sizes, 20)
    assert sorted(i for g in groups for i in g) == list(range(300)) and len(groups) == 20
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 5
    assert max(sum(sizes[i] for i in g) for g in packing.windows_of(sizes, 700)) <= 700


def test_edit_trees_count_like_whole_encoding(tokenizer):
    r = random.Random(3)
    parts = ["foo", "Bar's", "  ", " \n", "x1", "日本", "ü", "...", "\n\n", "we'll", " ", "a", "\t"]
    make = lambda n: "".join(r.choice(parts) + r.choice([" ", " ", "", " "]) for _ in range(n))
    encode = packing.Encoder(packing.tokenizer_path())
    for _ in range(60):
        text = make(r.choice([0, 1, 5, 60, 900, 5000]))
        tree = token_counts.Tree(encode, text)
        for _ in range(5):
            start, length, new = r.randrange(len(text) + 5), r.choice([0, 1, 3, 30, 300, 5000]), r.choice(["", "x", " ", "\n", " foo ", "' s", make(3), make(200)])
            tree.edit(start, length, new)
            text = text[:start] + new + text[start + length :] if start <= len(text) else text + new
            assert tree.text() == text and tree.tokens == len(tokenizer(text)) and tree.root[0] == len(text)


def test_recount_encodes_little_again(table, tokenizer):
    long = "some words of a text " * 3000
    rows = [(1, long, [(30000, 5, "new"), (10, 0, "x y")]), (2, None, [(0, 0, "born")]), (3, "", None), (4, "abc", [(None, None, None), None, (-5, 99, "")]), (None, "abc", []), (1, long, [])]
    got = token_counts.recount(table(rows, "doc_id long, text string, edits array<struct<start:long,length:long,insert:string>>", "n_tokens")).collect()
    for x, (_, t, _) in zip(got, rows):
        assert x.n_tokens == len(tokenizer(t or "")) and x.n_tokens_after == len(tokenizer(x.text_after)) and x.n_chars_after == len(x.text_after)
    assert got[1].text_after == "born" and got[3].n_edits == 2 and 0 < got[0].n_encoded_chars < 4000 and got[5].n_encoded_chars == 0


def plain_nearest(rows, k):
    ok = [(d, v) for d, v in rows if d is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({d for d, _ in ok if d % 5 == 0}):
        a = min(v for d, v in ok if d == q)
        ranked = sorted(((-sum(float(x) * float(y) for x, y in zip(a, v)), d) for d, v in ok if d != q))
        out += [(q, i + 1, d, round(-s, 9)) for i, (s, d) in enumerate(ranked[:k])]
    return out


def test_nearest(table, monkeypatch):
    r = random.Random(8)
    rows = [(i, [r.gauss(i % 3, 1) for _ in range(8)]) for i in range(300)]
    rows += [(400, rows[3][1]), (401, rows[3][1]), (402, [0.0] * 8), (403, None), (404, [1.0] * 7 + [None]), (405, [float("nan")] * 8), (406, [float("inf")] * 8), (407, []), (408, [1.0]), (None, [1.0] * 8)]
    df = table(rows, "vec_id long, embedding array<double>", "score", "rank")
    for block in (8192, 20):
        monkeypatch.setattr(neighbours, "QUERY_BLOCK", block)
        got = neighbours.nearest(df, F.col("vec_id") % 5 == 0, 20).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in got) == plain_nearest(rows, 20)
    few = neighbours.nearest(df.filter("vec_id < 4"), F.col("vec_id") % 5 == 0, 20).collect()
    assert len(few) == 3
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_recall_of_the_given_vectors(spark):
    sf = "/root/testdata/sf0.001"
    got = {(x.query_id, x.vec_id) for x in queries.QUERIES["op7_nearest_neighbours"](spark, sf).collect()}
    rows = [(x.vec_id, np.array(x.embedding, float)) for x in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    expected = set()
    for q, a in rows:
        if q % 20 == 0:
            expected |= {(q, d) for _, d in sorted((-(a @ v), d) for d, v in rows if d != q)[:20]}
    assert len(got & expected) >= 0.99 * len(expected) and len(got) == len(expected)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="menu"><a href=x>Home</a></div>
<div class="cookie-notice">Cookies</div><div class="wrap has-sidebar"><div class="post-content"><h2>Title &amp; more</h2><p>First  para <a href=y>link</a>
text, number %d.<p>Second &eacute; para, rather long so that it counts<ul><li>one<li>two</ul></div><div class="sidebar"><p>Side stuff</p></div>
<div class="comments"><p>Nice post!</p></div></div><form><p>f</p></form><aside>a</aside><footer>c</footer><script>var x="<p>no</p>";</script></body></html>"""
TEXT = "Title & more\n\nFirst para link text, number %d.\n\nSecond é para, rather long so that it counts\n\none\n\ntwo"


def test_main_text(table):
    url = "http://a.example/%d"
    rows = [(i, url % i, PAGE % i) for i in range(6)]
    other = [(10, None, None), (11, "", ""), (12, "odd", "plain text"), (13, "http://a.example/x", "<p>cut <b>off</b> here <a hre"), (14, "HTTP://u@B.example:80/", "<article><p>x<br>y</p></article><div class=ad>z</div>"), (None, None, PAGE % 9), (0, url % 0, PAGE % 0)]
    other += [(15, "http://c.example", "<article>" + "<p>word word</p>" * 3000 + "</article>")]
    got = main_text.extract(table(rows + other, "page_id long, url string, html string", "host", "path", "won")).collect()
    assert len(got) == len(rows) + len(other)
    text = {x.page_id: x.text for x in got}
    assert all(text[i] == TEXT % i for i in range(6)) and text[None] == TEXT % 9
    assert (text[10], text[11], text[12], text[13], text[14]) == ("", "", "plain text", "cut off here", "x y") and text[15].count("\n\n") == 2999
    assert {x.path for x in got if x.page_id in range(6)} == {"/html/body/div.wrap/div.post-content"}
    spread = main_text.extract(table(rows + other, "page_id long, url string, html string", "known", "dealt"), large_host=5).collect()
    assert sorted(map(repr, spread)) == sorted(map(repr, got))
    assert main_text.extract(table([], "page_id long, url string, html string")).count() == 0


def test_main_text_of_the_given_pages(spark):
    import html

    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op10_main_text"](spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for x in got:
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", x.html, re.DOTALL)[1])
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?h1>|</?p>", inside))
        assert x.text == "\n\n".join(b for b in blocks if b) and x.n_chars == len(x.text)


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.withColumn("score", F.lit(1)).withColumn("carried", F.lit("x")).withColumn("class_id", F.lit(2))
    odd = spark.createDataFrame([(None, "no id", None, None, None, 1, "x", 2), (10**9, None, "en", None, 0, 1, "x", 2), (10**9 + 1, "", None, "s", 0, 1, "x", 2)], extra.schema)
    docs, ids = extra.unionByName(odd), None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
            now = {x.doc_id for x in out.select("doc_id").collect()}
            assert ids is None or now <= ids
            ids = now
        docs = out
    assert {x.doc_id for x in docs.select("doc_id").collect()} == ids


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_pipeline_stage_on_an_empty_table(spark, stage):
    sf = "/root/testdata/sf0.001"
    assert stage(spark, spark.read.parquet(f"{sf}/documents.parquet").limit(0), sf).count() == 0
