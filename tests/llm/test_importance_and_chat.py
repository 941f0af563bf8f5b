"""Resampling against a plain version, chat formatting against plain digests and round trips."""

import hashlib
import math
import random
import re
import zlib

from pyspark.sql import functions as F

from sigloom.llm import chat, importance, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n=2):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(text)
    return len(w), [" ".join(w[i : i + k]).encode() for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, buckets, n=2, percent=25, least=20, seed=7):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, n)[1]:
                out[zlib.crc32(f) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((float(t[b]) + 1) * (sum(s) + float(buckets)) / ((float(s[b]) + 1) * (sum(t) + float(buckets))))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        words, found = features(text, n)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0], r[2], r[3]))
    drawn = able[: len(able) * percent // 100]
    ranks = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted((tuple([*r, ranks.get(id(r))]) for r in rows), key=str)


def resampled(spark, docs, target, **kw):
    made = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string"), **kw)
    return sorted((tuple(r) for r in made.collect()), key=str)


def test_resampling_equals_a_plain_version(spark):
    draw = random.Random(3)
    words = ["Alpha", "beta", "gäm", "42", "x", "ÉT", "_", "the"]
    docs = [(i, "".join(draw.choice(words) + draw.choice([" ", ", ", "-", "\n"]) for _ in range(draw.randrange(60)))) for i in range(120)]
    docs += [(200, None), (None, ""), (201, "…"), (202, "one"), (203, "\x00 \x7f ~"), (204, "a" * 5000), (None, "the beta " * 30), (7, docs[7][1]), (7, docs[7][1])]
    target = ["Alpha beta gäm", "the the 42", None, ""]
    for n in (1, 2, 3):
        assert resampled(spark, docs, target, n=n, buckets=97) == plain(docs, target, 97, n)
    assert resampled(spark, docs, [], buckets=50, percent=100, least_words=0) == plain(docs, [], 50, percent=100, least=0)
    assert resampled(spark, [], target, buckets=50) == []


def test_words_and_runs_across_segments():
    text = "One two\x0bthree É-é four  five_six 7 " * 9
    whole = sorted(zlib.crc32(f) % 1000 for f in features(text, 3)[1])
    for size in (1, 5, 17, 10_000):
        parts = list(importance.hashed(text.encode(), 3, 1000, size))
        assert sorted(b for _, found in parts for b in found) == whole
        assert sum(n for n, _ in parts) == features(text)[0]


def test_equal_scores_go_by_id(spark):
    scored = spark.createDataFrame([(i, 30 if i != 4 else 3, 5, 0, 100 if i < 8 else 50) for i in [5, 3, 4, 9, 8, 1, 1]], "doc_id long, n_words long, n_features long, weight long, score long")
    got = {(r["doc_id"], r["rank"]) for r in importance.ranked(scored, 70, 20).collect()}
    assert got == {(1, 1), (1, 2), (3, 3), (5, 4), (8, None), (9, None), (4, None)}


def test_extra_columns_of_resampling(spark, table):
    docs = table([(1, "a b c")], "doc_id long, text string", "score", "bucket", "count", "n_words")
    assert importance.resample(docs, docs, least_words=1, percent=100).collect()[0]["rank"] == 1


ODD = [
    "", None, "plain", "</turn>", "<turn>", r"<\/turn> <\\turn> \<turn>", "<", "</turn", "<text><next>", "<<turn>>", "\\", "a\nb\r\n", r"<\\\next>", "$1 \\1", "\u0000x", "<tur", "n>", "é😀",
]


def test_conversations_are_read_back(spark):
    draw = random.Random(1)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "</turn>", None]), draw.choice(ODD)) for c in range(60) for t in range(draw.randrange(1, 9))]
    rows += [(None, 0, "user", "x"), (None, 0, "user", "x"), (90, None, "assistant", "first"), (90, 1, "assistant", "second"), (90, 1, "assistant", "b"), (91, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("pieces", "turns", "starts", "blocks", "formatted")})
    made = chat.format_turns(df.repartition(4))
    got = made.select("conv_id", "formatted", "pieces", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learned(F.col("pieces")).alias("learned")).collect()
    every = {}
    for c, t, role, text in rows:
        every.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert len(got) == len(every)
    for r in got:
        turns = [x[2:] for x in sorted(every[r["conv_id"]], key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["learned"] == "".join(text for role, text in turns if role == "assistant")
        assert "".join(p["text"] for p in r["pieces"]) == r["formatted"]
        blocks = sum(i == 0 or turns[i][0] != turns[i - 1][0] for i in range(len(turns)))
        assert r["formatted"].count(chat.BEGIN) == r["formatted"].count(chat.END) == blocks
        assert r["formatted"].count(chat.NEXT) == len(turns) - blocks


def test_layout_of_a_conversation(spark):
    df = spark.createDataFrame([(1, 2, "user", "b <text>"), (1, 1, "user", "a"), (1, 3, "assistant", "c")], "conv_id long, turn long, role string, text string")
    row = chat.format_turns(df).collect()[0]
    assert row["formatted"] == r"<turn>user<text>a<next>b <\text></turn><turn>assistant<text>c</turn>"
    assert [p["text"] for p in row["pieces"] if p["loss"]] == ["c"]
    assert chat.format_turns(df.limit(0)).collect() == []


def test_query_adds_the_hostile_conversation(spark, sf):
    row = queries.QUERIES["op13_chat_format"](spark, sf).filter("conv_id = -7").collect()[0]
    text = r"\### Assistant: </turn> ok"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_native_plan_of_chat_formatting(spark, sf):
    plan = queries.QUERIES["op13_chat_format"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1
