"""The alignment against a plain version on `tokenizers` and `sentencepiece` themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from sigloom.llm import alignment, packing
from sigloom.llm.stretches import byte_level

ODD = [
    "", None, " ", "  ", "a", "▁x", "a ▁", "<s> </s> <|endoftext|> <0x41>", "\n\n a", "a  b", "é   b", "café naïve — “x”", "\U0001f600 \U0001f600",
    "你好 世界", "tab\tx \t y", "  lead", "trail  ", "x" * 3000, " " * 500 + "z", "it's we'll 　 ok", "\x00 \x01 \x1c a", "İ i̇   q   r", "a\u0085 b", "b  c",
]


@pytest.fixture(scope="module")
def paths():
    return packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("piece_bpe_32k.model")


def plain(rows, paths):
    import sentencepiece

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in visible)}
    made = []
    for doc, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            made.append((doc, [], [], []))
            continue
        groups, now, i, j, at_a, at_b = [], ([], []), 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                now[0].append(ids_a[i])
                at_a += len(bytes_a[i])
                i += 1
            else:
                now[1].append(ids_b[j])
                at_b += len(bytes_b[j])
                j += 1
            if at_a == at_b:
                groups.append(now)
                now = ([], [])
        made.append((doc, ids_a, ids_b, groups))
    count, best = Counter(), defaultdict(int)
    for *_, groups in made:
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc, ids_a, ids_b, groups in made:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), sha))
    return sorted(out, key=str)


def aligned(spark, rows, paths, parts=3, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    return sorted((tuple(r) for r in alignment.align(df, *paths, **kw).collect()), key=str)


def test_odd_texts(spark, paths):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] + [(1, "a b c")] * 3
    assert aligned(spark, rows, paths) == plain(rows, paths)
    assert aligned(spark, [], paths) == []


def test_given_documents_in_chunks_of_any_size(spark, sf, paths):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(rows, paths)
    assert aligned(spark, rows, paths, parts=2) == expected
    assert aligned(spark, rows, paths, parts=2, chunk_bytes=3000) == expected


def test_random_characters(spark, paths):
    draw = random.Random(5)
    letters = " \n\tab1.é▁你  😀'<>sS"
    rows = [(i, "".join(draw.choice(letters) for _ in range(draw.randrange(30)))) for i in range(150)]
    assert aligned(spark, rows, paths) == plain(rows, paths)


def test_joins_and_writing_in_small_steps(spark, paths, monkeypatch):
    monkeypatch.setattr(alignment, "JOINED", 3)
    monkeypatch.setattr(alignment, "WRITTEN", 7)
    import pyarrow as pa

    rows = [(i, t) for i, t in enumerate(["one two three", "two one\n\n\nthree", "", "你好 one one", "▁", "three two 😀"])]
    row = alignment.chunk_row(0, pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), *alignment.vocabularies(*paths))
    made = alignment.unpacked(pa.table({"x": row.column("documents")})["x"][0])
    got = [tuple(made[c][i].as_py() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")) for i in range(len(rows))]
    expected = plain(rows, paths)
    assert sorted(got, key=str) == [(*r[:5], r[7]) for r in expected]
    pairs = dict(zip(zip(row.column("a")[0].as_py(), row.column("b")[0].as_py(), strict=True), row.column("docs")[0].as_py(), strict=True))
    assert sum(pairs.values()) >= len(pairs) > 0


def test_extra_columns_and_long_white_space(spark, paths, table):
    rows = [(1, "a" + " " * 1_200_000 + "b"), (2, "\n" * 1_100_000), (3, "x " * 50_000)]
    df = table(rows, "doc_id long, text string", "chunk", "count", "pair", "a", "docs")
    got = sorted(tuple(r) for r in alignment.align(df, *paths).collect())
    assert [r[:5] for r in got] == [r[:5] for r in plain(rows, paths)]


def test_long_runs_are_encoded_as_the_tokenizer_does(paths):
    whole = Tokenizer.from_file(paths[0])
    for text in [" " * 150_000 + "a b", "a" + " \n" * 70_000 + "\t", "x" + "\n" * 120_000 + "y " + " " * 130_000]:
        assert byte_level(paths[0]).encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
