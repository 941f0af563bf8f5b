"""Licence scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser reads their expressions.

Texts are read as lower-cased words joined by one blank, so that a phrase's words are found where they stand consecutively. The
automaton runs once over a text and knows all phrases. Where it meets an identifier tag, the expression behind the tag is
taken from the text itself (up to the end of its line), parsed (`with` before `and` before `or`, parentheses) and evaluated:
`and` needs the licences of both sides, of an `or` the side with the more permissive licences is chosen.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans

#: fixed values: phrases that count in every scan, and their labels
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: more notices that the operator knows by itself
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
TAG_TEXT = re.compile(r"spdx-license-identifier[ \t]*:?[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: how free a licence family leaves the user, most permissive first
FAMILIES = ["public-domain", "mit", "bsd", "isc", "apache", "cc-by", "mpl", "epl", "lgpl", "gpl", "agpl", "other", "reserved"]
PREFIXES = {"0bsd": "bsd", "unlicense": "public-domain", "cc0": "public-domain", "cc-by": "cc-by", "mit": "mit", "bsd": "bsd", "isc": "isc", "apache": "apache", "mpl": "mpl", "epl": "epl", "lgpl": "lgpl", "agpl": "agpl", "gpl": "gpl"}
BINDS = {"or": 1, "and": 2, "with": 3}
FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_notices long, expressions array<string>"


def family(identifier: str) -> str:
    name = identifier.lower()
    return next((f for p, f in PREFIXES.items() if name == p or name.startswith((p + "-", p + "+"))), "other")


def postfix(expression: str) -> list[str] | None:
    """The expression's licences and operators in the order of evaluation, None if it is none."""
    out, stack, operand = [], [], False
    for token in TOKEN.findall(expression):
        word = token.lower()
        if word in BINDS:
            if not operand:
                return None
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = False
        elif token == "(":
            if operand:
                return None
            stack.append("(")
        elif token == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if operand:
                break  # prose behind the expression
            out.append(token)
            operand = True
    if not operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(tokens: list[str]) -> tuple[frozenset[str], str]:
    """The licence families that have to be kept to, and the expression in full parentheses."""
    stack: list[tuple[frozenset[str], str]] = []
    for token in tokens:
        if token not in BINDS:
            stack.append((frozenset([family(token)]), token))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if token == "with":
            kept = a
        elif token == "and":
            kept = a | b
        else:
            kept = min((a, b), key=lambda s: (max(map(FAMILIES.index, s)), len(s)))
        stack.append((kept, f"({left} {token} {right})"))
    return stack[0]


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for phrase in [*BASE, *MORE, TAG]:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


def scan_text(joined: str, text: str) -> tuple:
    """One text's row, from its words joined by blanks and its own characters."""
    n = joined.count(" ") + 1 if joined else 0
    base, own, labels, notices, tags = [], set(), set(), 0, False
    padded = f" {joined} "
    for end, phrase in automaton().iter(padded):
        if phrase == TAG:
            tags = True
            continue
        notices += 1
        if phrase in BASE:
            base.append(end - len(phrase) - 1)
            own.add(BASE[phrase])
        else:
            labels.add(MORE[phrase])
    expressions = []
    if tags:
        for match in TAG_TEXT.finditer(text):
            parsed = postfix(match[1])
            if parsed:
                families, shown = evaluate(parsed)
                labels |= families
                expressions.append(shown)
    starts = [padded.count(" ", 0, at) for at in (min(base), max(base))] if base else [None, None]
    score = 1.0 if expressions else 1 - 0.5 ** (len(base) + 0.5 * (notices - len(base)))
    return n, len(base), *starts, ",".join(sorted(own)), ",".join(sorted(own | labels)), score, notices, expressions


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, n_words, n_base (places of base phrases), first_word and last_word (the
    smallest and largest word number where one starts), base_labels, labels (of all phrases and expressions), score (1 with
    a parsed expression, else rising with the number of notices from 0), n_notices, expressions (in full parentheses).

    Null and empty texts have no words and score 0. A broken expression counts for nothing. Whole texts are read. Rows that repeat
    or have a null doc_id are scanned like others; other columns are ignored.
    """
    blank = np.full(256, 0x20, np.uint8)
    blank[spans.WORDLIKE] = np.flatnonzero(spans.WORDLIKE)
    lowered = blank[spans.LOWER].tobytes()

    def run(batches):
        for batch in batches:
            for part, data, at in spans.chunks(batch, "text"):
                found = spans.words(spans.LOWER[data], at, spans.WORDLIKE)
                clean = np.frombuffer(data.tobytes().translate(lowered), np.uint8)
                joined, to = spans.join_words(clean, found, np.ones(len(found.start), bool))
                rows = [scan_text(j, t or "") for j, t in zip(spans.strings(joined, to).to_pylist(), part.column("text").to_pylist(), strict=True)]
                columns = list(zip(*rows, strict=True))
                kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_notices", "expressions"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)
