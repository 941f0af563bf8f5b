"""Edit-aware token counts: a segment tree over each document's pre-token stretches, of which edits touch only a few leaves.

A leaf holds a stretch of text of about `LEAF` characters and its number of tokens; leaves end before a single blank between two
characters that are no white space, where a byte-level pre-token can't go on. An inner node holds the sums of characters and
tokens below it. An edit is located by the sums; the leaves it touches, and the next one on each side as boundary
context, are joined, edited, cut and encoded again, and the sums above them are updated. The rest isn't encoded again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .packing import Encoder, encoder, tokenizer_path

LEAF = 256
FANOUT = 16
COUNTED = "doc_id long, n_tokens long, n_tokens_after long, n_chars long, n_chars_after long, n_edits long, n_encoded_chars long, text_after string"


class Tree:
    """The leaves of one text in groups of up to 2 * FANOUT, and groups of groups, each with its sums (characters, tokens)."""

    def __init__(self, encode: Encoder, text: str):
        self.encode = encode
        self.encoded = 0
        self.root = self._build(self._leaves(text))

    def _leaves(self, text: str) -> list[list]:
        parts = self.encode.stretches(text) if text else []
        pieces: list[str] = []
        now: list[str] = []
        size = 0
        for i, part in enumerate(parts):
            now.append(part if i == 0 else " " + part)
            size += len(now[-1])
            if size >= LEAF:
                pieces.append("".join(now))
                now, size = [], 0
        if now:
            pieces.append("".join(now))
        self.encoded += len(text)
        return [[len(p), len(ids) // 4, p] for p, ids in zip(pieces, self.encode.batch(pieces), strict=True)]

    def _build(self, nodes: list[list]) -> list:
        """A node is [characters, tokens, text] or [characters, tokens, [nodes]]."""
        while len(nodes) > FANOUT or not nodes or isinstance(nodes[0][2], str):
            groups = [nodes[i : i + FANOUT] for i in range(0, len(nodes), FANOUT)] or [[]]
            nodes = [[sum(n[0] for n in g), sum(n[1] for n in g), g] for g in groups]
        return nodes[0] if len(nodes) == 1 else [sum(n[0] for n in nodes), sum(n[1] for n in nodes), nodes]

    @property
    def tokens(self) -> int:
        return self.root[1]

    def text(self) -> str:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node[2], str):
                out.append(node[2])
            else:
                stack += node[2][::-1]
        return "".join(out)

    def edit(self, start: int, length: int, new: str) -> None:
        """Replaces `length` characters from `start` on; both are cut to the text's bounds."""
        start = min(max(0, start), self.root[0])
        stop = min(max(start, start + length), self.root[0])
        self._replace(self.root, start, stop, new)
        while len(self.root[2]) == 1 and not isinstance(self.root[2][0][2], str):
            self.root = self.root[2][0]
        if len(self.root[2]) > 2 * FANOUT:
            self.root = self._build(self.root[2])

    def _replace(self, node: list, start: int, stop: int, new: str) -> None:
        below = node[2]
        at, touched = 0, []
        for k, child in enumerate(below):
            # the neighbours that end or begin at the edit's bounds belong to it: tokens may join across
            if at <= stop and at + child[0] >= start:
                touched.append((k, at))
            at += child[0]
        lone = len(touched) == 1 and not isinstance(below[touched[0][0]][2], str)
        if lone and 0 < touched[0][0] < len(below) - 1:
            k, first = touched[0]
            if first < start - LEAF and stop + LEAF < first + below[k][0]:  # far from the child's bounds
                self._replace(below[k], start - first, stop - first, new)
                if not below[k][2]:
                    del below[k]
                elif len(below[k][2]) > 2 * FANOUT:
                    half = len(below[k][2]) // 2
                    below[k : k + 1] = [[sum(n[0] for n in g), sum(n[1] for n in g), g] for g in (below[k][2][:half], below[k][2][half:])]
                node[0], node[1] = sum(n[0] for n in below), sum(n[1] for n in below)
                return
        if below and not isinstance(below[0][2], str):
            # an edit near or across bounds of groups: open the groups that it and its context meet
            low, high = max(0, touched[0][0] - 1), min(len(below), touched[-1][0] + 2)
            flat = [leaf for child in below[low:high] for leaf in self._flat(child)]
            first = sum(child[0] for child in below[:low])
            mended = [0, 0, flat]
            self._replace(mended, start - first, stop - first, new)
            depth = self._depth(below[0])
            groups = mended[2]
            for _ in range(depth):
                groups = [[sum(n[0] for n in g), sum(n[1] for n in g), g] for g in (groups[i : i + FANOUT] for i in range(0, len(groups), FANOUT))]
            below[low:high] = groups
        else:
            low, high = (max(0, touched[0][0] - 1), min(len(below), touched[-1][0] + 2)) if touched else (0, len(below))
            first = sum(leaf[0] for leaf in below[:low])
            old = "".join(leaf[2] for leaf in below[low:high])
            text = old[: start - first] + new + old[stop - first :]
            # what follows must begin at a safe blank, what is before must not end in white space
            while high < len(below) and not (text and not text[-1].isspace() and safe(below[high][2])):
                text += below[high][2]
                high += 1
            while low > 0 and not (safe(text) and not below[low - 1][2][-1].isspace()):
                low -= 1
                text = below[low][2] + text
            below[low:high] = self._leaves(text) if low == 0 else self._inner(text)
        node[0], node[1] = sum(n[0] for n in below), sum(n[1] for n in below)

    def _inner(self, text: str) -> list[list]:
        """Leaves of a text that begins with a safe blank; the blank stays with its pre-token."""
        return self._leaves(text)

    def _flat(self, node: list) -> list[list]:
        if isinstance(node[2], str):
            return [node]
        return [leaf for child in node[2] for leaf in self._flat(child)]

    def _depth(self, node: list) -> int:
        return 0 if isinstance(node[2], str) else 1 + self._depth(node[2][0])


def safe(text: str) -> bool:
    return len(text) > 1 and text[0] == " " and not text[1].isspace()


def recount(docs: DataFrame, edits: str = "edits", path: str | None = None, encode_special_tokens: bool = True) -> DataFrame:
    """One row for each row of docs (doc_id, text, edits): doc_id, n_tokens before the edits and n_tokens_after, n_chars and n_chars_after,
    n_edits, n_encoded_chars (characters encoded again because of edits), text_after.

    `edits` names an array of structs (start, length, insert), done in order, each on the text as the one before left it:
    `length` characters from `start` on (from 0) are replaced by `insert`. Bounds outside the text are cut to it; null fields
    count as 0 or empty, null edits as none. Null and empty texts have 0 tokens before. Rows that repeat or have a null doc_id
    are counted like others; other columns are ignored. `encode_special_tokens`: see `packing.Encoder`.
    """

    def run(batches):
        encode = encoder(path or tokenizer_path(), encode_special_tokens)
        for batch in batches:
            for part, _, _ in spans.chunks(batch, "text"):
                rows = []
                for text, todo in zip(part.column("text").to_pylist(), part.column("edits").to_pylist(), strict=True):
                    tree = Tree(encode, text or "")
                    before, size, tree.encoded = tree.tokens, tree.root[0], 0
                    for e in todo or ():
                        if e is not None:
                            tree.edit(e["start"] or 0, e["length"] or 0, e["insert"] or "")
                    rows.append((before, tree.tokens, size, tree.root[0], sum(e is not None for e in todo or ()), tree.encoded, tree.text()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.string() if k == 6 else pa.int64()) for k, c in enumerate(columns))],
                    names=["doc_id", "n_tokens", "n_tokens_after", "n_chars", "n_chars_after", "n_edits", "n_encoded_chars", "text_after"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(edits).alias("edits")).mapInArrow(run, COUNTED)
