"""Alignment of two tokenizers' ids by the bytes they stand for.

Each task works on Arrow columns in chunks of bounded size. A text is a row of stretches that both vocabularies encode apart (`stretches.py`),
so the distinct stretches of a chunk are aligned once, each like a document of its own: ids are flattened with their parent indices,
segmented running sums of byte lengths give every token's end, and an Acero hash join on (stretch, end) finds the ends that both
share. Another join, on the group between two shared ends, makes the links, and `Table.group_by` adds them up. What a document holds follows
from the stretches it is made of.

Spark merges the chunks' partial counts of id pairs, looks up each chunk's pairs in the merged counts (a pair is in one row of a chunk, however
frequent it is) and hands a chunk's counts to the documents of the chunk. Between the two halves lies a table in the shared folder, so
nothing is encoded twice.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.session import ensure_checkpoint_dir

from . import spans
from .stretches import ByteLevel, buffers, byte_level, cuts, distinct, expand

#: bytes of text in a chunk, or one document
CHUNK_BYTES = 5 << 19
#: rows that a join of one step makes, or those of one token of a group
JOINED = 1 << 21
#: bytes of groups that are written out at a time, or one stretch
WRITTEN = 1 << 24

EMPTY, BLANK = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())

#: a chunk: its documents and the links of its stretches as Arrow streams, its pairs of ids and how many documents have each linked
ROWS = "chunk long, documents binary, links binary, a array<int>, b array<int>, docs array<int>"
SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def packed(columns: dict) -> bytes:
    """Columns as a compressed Arrow stream: Spark moves one value for a chunk, not each number of it."""
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(value: pa.Scalar) -> pa.Table:
    with pa.ipc.open_stream(value.as_buffer()) as made:
        return made.read_all().combine_chunks()


class Pieces:
    """Ids of a sentence-piece vocabulary with bytes as a last resort."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece has a blank behind another character, so texts can't be cut at blanks")
        byte = [self.model.is_byte(i) for i in range(len(pieces))]
        self.entries = [bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, byte, strict=True)]

    def encode_each(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of stretches and each one's place among them; a stretch begins with the blank that the vocabulary adds itself."""
        ids = self.model.encode([w[1:].decode() for w in words.to_pylist()], num_threads=1)
        flat = pa.array(ids, pa.list_(pa.int32()))
        return flat.values.to_numpy(), flat.offsets.to_numpy().astype(np.int64)


class Vocabulary:
    """Bytes, their number and decimal text of each id, as Arrow columns."""

    def __init__(self, encoder: ByteLevel | Pieces):
        self.encode_each = encoder.encode_each
        self.bytes = pa.array(encoder.entries, pa.large_binary())
        self.length = pc.binary_length(self.bytes).cast(pa.int64())
        self.text = pa.array([str(i) for i in range(len(encoder.entries))], pa.string())


@lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> tuple[Vocabulary, Vocabulary]:
    return Vocabulary(byte_level(path_a)), Vocabulary(Pieces(path_b))


def lists(values, place: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(place, pa.int64()), values if isinstance(values, pa.Array) else pa.array(values))


def texts(values: pa.Array, place: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(place, pa.int32()), values), by)


def joined(table: pa.Table, other: pa.Table, keys: list[str]) -> pa.Table:
    return table.join(other, keys, join_type="inner", use_threads=False)


class Tokens:
    """One vocabulary's tokens of stretches: which stretch, id and end of each, ends counted in bytes from the stretch's start."""

    def __init__(self, vocabulary: Vocabulary, words: pa.Array):
        ids, self.place = vocabulary.encode_each(words)
        column = lists(pa.array(ids.astype(np.int32)), self.place)
        self.ids, self.word = pc.list_flatten(column), pc.list_parent_indices(column)
        ends = pc.cumulative_sum(vocabulary.length.take(self.ids)).to_numpy()
        before = np.concatenate([np.zeros(1, np.int64), ends])[self.place]
        self.total = np.diff(before)
        self.end = pa.array(ends - before[:-1][self.word.to_numpy()])
        data, at = buffers(vocabulary.bytes.take(self.ids))
        self.bytes, self.at = data, at[self.place]
        self.text = vocabulary.text.take(self.ids)

    def spell(self, words: pa.Array) -> np.ndarray:
        """Whether the tokens' bytes are the stretch's."""
        data, at = buffers(words)
        right = self.total == np.diff(at)
        if right.all() and np.array_equal(self.bytes, data):
            return right
        for w in np.flatnonzero(right):
            right[w] = np.array_equal(self.bytes[self.at[w] : self.at[w + 1]], data[at[w] : at[w + 1]])
        return right

    def ends(self) -> pa.Table:
        return pa.table({"word": self.word, "end": self.end})


class Aligned:
    """The distinct stretches of a chunk: tokens, groups, links and the text of the groups of each."""

    def __init__(self, words: pa.Array, a: Vocabulary, b: Vocabulary):
        in_a, in_b = Tokens(a, words), Tokens(b, words)
        self.right = in_a.spell(words) & in_b.spell(words)
        self.n_a, self.n_b = np.diff(in_a.place), np.diff(in_b.place)
        shared = joined(in_a.ends(), in_b.ends(), ["word", "end"]).sort_by([("word", "ascending"), ("end", "ascending")])
        word, end = shared["word"].to_numpy(), shared["end"].to_numpy()
        # ends ascend within a stretch, so one number orders (stretch, end)
        base = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.maximum(in_a.total, in_b.total) + 1)])
        key = base[word] + end
        self.n_groups = np.bincount(word, minlength=len(words))
        group_a = np.searchsorted(key, base[in_a.word.to_numpy()] + in_a.end.to_numpy())
        group_b = np.searchsorted(key, base[in_b.word.to_numpy()] + in_b.end.to_numpy())
        # a stretch that is spelt otherwise may end without a group; its documents have no tokens at all
        right_a, right_b = (pa.array(self.right[t.word.to_numpy()]) for t in (in_a, in_b))
        group_a, group_b = pa.array(group_a).filter(right_a), pa.array(group_b).filter(right_b)
        number = np.arange(len(word) + 1)
        sides = [texts(t.text.filter(r), np.searchsorted(g.to_numpy(), number), ",") for t, r, g in ((in_a, right_a, group_a), (in_b, right_b, group_b))]
        groups = pc.binary_join_element_wise(*sides, "|")
        self.text = texts(groups, np.searchsorted(word, np.arange(len(words) + 1)), ";")
        self.links = self._links(pa.table({"group": group_a, "a": in_a.ids.filter(right_a)}), pa.table({"group": group_b, "b": in_b.ids.filter(right_b)}), word)

    def _links(self, a: pa.Table, b: pa.Table, word: np.ndarray) -> pa.Table:
        """Rows (word, a, b, n): how often ids are linked in a stretch. Tokens of one id in one group go together before they are joined."""
        a = a.group_by(["group", "a"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "a", "n_a"]).sort_by("group")
        b = b.group_by(["group", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "b", "n_b"])
        partners = np.bincount(b["group"].to_numpy(), minlength=len(word) + 1)
        made = np.cumsum(partners[a["group"].to_numpy()])
        parts, left = [], 0
        while left < len(a):
            right = max(left + 1, int(np.searchsorted(made, (made[left - 1] if left else 0) + JOINED, "right")))
            pairs = joined(a.slice(left, right - left), b, ["group"])
            pairs = pa.table({"word": word[pairs["group"].to_numpy()], "a": pairs["a"], "b": pairs["b"], "n": pc.multiply(pairs["n_a"], pairs["n_b"])})
            parts.append(added(pairs, ["word", "a", "b"], "n"))
            left = right
        if not parts:
            return pa.table({"word": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        return added(pa.concat_tables(parts), ["word", "a", "b"], "n") if len(parts) > 1 else parts[0]


def added(table: pa.Table, keys: list[str], value: str) -> pa.Table:
    return table.group_by(keys, use_threads=False).aggregate([(value, "sum")]).rename_columns([*keys, value])


def digests(text: pa.Array, which: np.ndarray, first: np.ndarray) -> list[str]:
    """SHA-256 of the texts of each document's stretches, joined by semicolons; some stretches at a time."""
    out, now, row = [], hashlib.sha256(), 0
    rows = len(first) - 1
    written = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64)[which])
    left = 0
    while left < len(which):
        right = max(left + 1, int(np.searchsorted(written, (written[left - 1] if left else 0) + WRITTEN, "right")))
        # pieces of the slice, a document each, with the stretch at which they start
        starts = np.unique([left, *first[(first > left) & (first < right)], right])
        for start, value in zip(starts[:-1].tolist(), texts(text.take(pa.array(which[left:right])), starts - left, ";").to_pylist(), strict=True):
            while row < rows and first[row + 1] <= start:
                out.append(now.hexdigest())
                now, row = hashlib.sha256(), row + 1
            if start > first[row]:
                now.update(b";")
            now.update(value.encode())
        left = right
    while row < rows:
        out.append(now.hexdigest())
        now, row = hashlib.sha256(), row + 1
    return out


def chunk_row(chunk: int, ids: pa.Array, texts: pa.Array, a: Vocabulary, b: Vocabulary) -> pa.RecordBatch:
    """A chunk as a row of `ROWS`."""
    filled = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
    data, offsets = buffers(pc.binary_join_element_wise(EMPTY, texts.take(pa.array(filled)).cast(pa.large_string()), BLANK))
    at, first = cuts(data, offsets)
    words, which = distinct(data, at)
    made = Aligned(words, a, b)
    row = np.repeat(np.arange(len(filled)), np.diff(first))
    wrong = np.unique(row[~made.right[which]])
    good = np.ones(len(filled), bool)
    good[wrong] = False

    n = len(texts)
    links = made.links
    per_word = np.bincount(links["word"].to_numpy(), links["n"].to_numpy(), len(words)).astype(np.int64)
    numbers = np.zeros((4, n), np.int64)
    for k, values in enumerate([made.n_a, made.n_b, made.n_groups, per_word]):
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values[which])])
        numbers[k, filled] = np.where(good, total[first[1:]] - total[first[:-1]], 0)
    sha = np.full(n, "", object)
    sha[filled] = np.where(good, np.array(digests(made.text, which, first), object), "")

    # distinct stretches of documents, and how many documents have each linked pair
    held = pa.table({"row": row, "word": which}).filter(pa.array(good[row])).group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["row", "word", "n"]).sort_by([("row", "ascending"), ("word", "ascending")])
    code = (links["a"].to_numpy().astype(np.int64) << 32) | links["b"].to_numpy()
    pairs, pair = np.unique(code, return_inverse=True)
    order = np.argsort(links["word"].to_numpy(), kind="stable")
    place = np.searchsorted(links["word"].to_numpy()[order], np.arange(len(words) + 1))
    docs = count_documents(held["row"].to_numpy(), held["word"].to_numpy(), pair[order], place, len(pairs))

    held_at = np.searchsorted(filled[held["row"].to_numpy()], np.arange(n + 1))
    words_held = pa.ListArray.from_arrays(pa.array(held_at, pa.int32()), held["word"].combine_chunks().cast(pa.int32()))
    times = pa.ListArray.from_arrays(pa.array(held_at, pa.int32()), held["n"].combine_chunks().cast(pa.int32()))
    documents = {"doc_id": ids.cast(pa.int64()), **dict(zip(["n_a", "n_b", "n_groups", "n_links"], numbers, strict=True)), "groups_sha256": pa.array(sha, pa.string()), "words": words_held, "times": times}
    linked = {"word": links["word"].to_numpy()[order].astype(np.int32), "pair": pair[order].astype(np.int32), "times": links["n"].to_numpy()[order]}
    row = [pa.array([chunk]), *(pa.array([packed(x)], pa.binary()) for x in (documents, linked))]
    row += [pa.array([v.astype(np.int32)], pa.list_(pa.int32())) for v in (pairs >> 32, pairs & 0xFFFFFFFF, docs)]
    return pa.RecordBatch.from_arrays(row, names=["chunk", "documents", "links", "a", "b", "docs"])


def count_documents(row: np.ndarray, word: np.ndarray, pair: np.ndarray, place: np.ndarray, pairs: int) -> np.ndarray:
    """In how many documents each pair is linked; rows (row, word) ascend by row, some rows at a time."""
    docs = np.zeros(pairs, np.int64)
    made = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.diff(place)[word])])
    left = 0
    while left < len(row):
        right = int(np.searchsorted(made, made[left] + JOINED, "right")) - 1
        right = int(np.searchsorted(row, row[max(right, left + 1) - 1], "right")) if right <= left + 1 or right >= len(row) else int(np.searchsorted(row, row[right], "left"))
        right = right if right > left else int(np.searchsorted(row, row[left], "right"))
        linked, at = expand(pair, place, word[left:right])
        once = pa.table({"row": np.repeat(row[left:right], np.diff(at)), "pair": linked}).group_by(["row", "pair"], use_threads=False).aggregate([])
        docs += np.bincount(once["pair"].to_numpy(), minlength=pairs)
        left = right
    return docs


def aligned(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows `ROWS` of docs (doc_id, text), one for each chunk."""

    def run(batches):
        a, b = vocabularies(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        for table in batches:
            for part, _, _ in spans.chunks(table, "text", chunk_bytes):
                ids, texts = (x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (part.column("doc_id"), part.column("text")))
                yield chunk_row(chunk, ids, texts, a, b)
                spans.give_back()
                chunk += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ROWS)


def scored(table: pa.Table) -> pa.Table:
    """A chunk's documents with the counts of their links."""
    looked = table.filter(pc.is_valid(table["pair"]))
    own = table.filter(pc.is_valid(table["documents"]))
    documents, links = unpacked(own["documents"][0]), unpacked(own["links"][0])
    at = looked["pair"].to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at], best[at] = looked["count"].to_numpy(), looked["best"].to_numpy()
    held, times = (pc.list_flatten(documents[c]).to_numpy() for c in ("words", "times"))
    place = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.list_value_length(documents["words"]).to_numpy())])
    size = max(held.max(initial=-1), links["word"].to_numpy().max(initial=-1)) + 1
    made = []
    for values in (best, count):
        per_word = np.zeros(size, np.int64)
        np.add.at(per_word, links["word"].to_numpy(), links["times"].to_numpy() * values[links["pair"].to_numpy()])
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(times * per_word[held])])
        made.append(pa.array(total[place[1:]] - total[place[:-1]]))
    numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table([*(documents[c] for c in numbers), *made, documents["groups_sha256"]], names=[*numbers, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows `SCORED`, one for each row of docs (doc_id, text).

    A is the byte-level vocabulary of a tokenizer file, on a blank and the text; B the sentence-piece model, on the text, to which it adds the
    blank. Special tokens' texts are ordinary text. Byte ends that tokens of both have cut a text into groups; all tokens of A and of B
    in a group are linked. A pair's count is the number of rows of docs that hold it linked, over the whole table. `n_best` counts links
    whose count is the highest of their A id, ties included, `count_sum` adds up counts over links, `groups_sha256` hashes
    `a1,a2|b1;a3|b2`. A null or empty text, and one whose tokens of A or B don't spell a blank and the text (it holds the character that stands
    for a blank), has no tokens: zeros and ''. Rows that repeat or have a null doc_id count like others. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    aligned(docs, path_a, path_b, chunk_bytes).write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(ROWS).parquet(folder)
    pairs = rows.select("chunk", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("pair", "x")).select("chunk", "pair", "x.a", "x.b", "x.docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # a row for each id of A at most: the vocabulary bounds it
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    counts = counts.join(F.broadcast(highest), "a").withColumn("best", (F.col("count") == F.col("highest")).cast("long"))
    looked = pairs.join(counts, ["a", "b"]).select("chunk", "pair", "count", "best")
    return rows.select("chunk", "documents", "links").unionByName(looked, allowMissingColumns=True).groupBy("chunk").applyInArrow(scored, SCORED)
