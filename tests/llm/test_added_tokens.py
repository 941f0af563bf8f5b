"""Ids and counts of texts with the tokenizer file's added tokens, against `tokenizers` as the file is."""

import random

import numpy as np
import pytest

import corpus_pipeline
from sigloom.llm import packing, queries, token_counts

END = "<|endoftext|>"
TEXTS = [f"a {END} hi", END, f"{END}{END}", f"a  {END}  b", f"a\n{END}\n b {END}", f"x{END}y", f" {END} ", f"a {END[:-1]} {END[1:]} <|endofText|>", "plain words", "", None, f"long text {END} of words, " * 900]


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(packing.tokenizer_path())
    return lambda text: made.encode(text, add_special_tokens=False).ids


def test_encoder(ids):
    made = packing.Encoder(packing.tokenizer_path(), encode_special_tokens=False)
    assert ids(TEXTS[0]) == [64, 220, 50256, 23105]
    assert [np.frombuffer(b, np.uint32).tolist() for b in made.batch([t or "" for t in TEXTS])] == [ids(t or "") for t in TEXTS]


def test_edits_that_make_and_break_added_tokens(ids):
    made, r = packing.Encoder(packing.tokenizer_path(), encode_special_tokens=False), random.Random(6)
    for _ in range(40):
        text = "".join(r.choice(["foo", END, "  ", " \n", "<|endof", "text|>", "ü"]) + r.choice([" ", ""]) for _ in range(r.choice([1, 30, 900])))
        tree = token_counts.Tree(made, text)
        for _ in range(5):
            start, length, new = r.randrange(len(text) + 5), r.choice([0, 1, 3, 30, 300]), r.choice(["", "x", " ", END, "<|endof", "text|>", f" {END} a"])
            tree.edit(start, length, new)
            text = text[:start] + new + text[start + length :] if start <= len(text) else text + new
            assert tree.text() == text and tree.tokens == len(ids(text))


def test_queries_and_the_pipeline(spark, table, tmp_path, ids):
    docs = table(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    counted = {x.doc_id: x.n_tokens for x in queries.QUERIES["op6_token_counts"](spark, str(tmp_path)).collect()}
    assert counted == {i: len(ids(t or "")) for i, t in enumerate(TEXTS)}
    packed = {x.doc_id: x.doc_tokens for x in queries.QUERIES["op8_packing"](spark, str(tmp_path)).collect()}
    assert packed == {i: len(ids(t or "")) + 1 for i, t in enumerate(TEXTS)}
    parts = {}
    for x in sorted(corpus_pipeline.sequence_packing(spark, docs, str(tmp_path)).collect(), key=lambda x: x.start):
        parts.setdefault(x.doc_id, []).extend(np.frombuffer(x.ids, np.uint32).tolist())
    assert parts == {i: [*ids(t or ""), packing.END_ID] for i, t in enumerate(TEXTS)}
