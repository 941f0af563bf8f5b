"""Resampling of documents towards a target text, by hashed n-gram counts.

A 256-byte table lower-cases A-Z and blanks separators in UTF-8, `bytes.split` yields words, chained CRC-32 seeds extend words to n-grams
(the checksum of the words so far is the seed of the next one), and Counters reduce buckets inside a task before Spark adds them up. The counts
are bounded by the number of buckets, so their gains travel with the second pass, which sums them over each document. Weights get Gumbel
noise from a hash of the document's id; the highest are the draw.

Scores are whole thousandths of logarithms, so there are few distinct ones however many documents there are. Ranks are the running sum over
the scores' counts and a place among equal scores; no window holds all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.session import cut_lineage

from . import spans

#: separators become blanks, A-Z lower case, all else stays
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLANK_RUN = re.compile(rb" +")
#: bytes of a text that are split at a time
SEGMENT = 1 << 20
BUCKETS, N, SEED = 10_000, 2, 7
PERCENT, LEAST_WORDS = 25, 20
SCORED = "doc_id long, n_words long, n_features long, weight long"


def segments(data: bytes, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """The words of a translated text, those of about `size` bytes at a time; a word is never cut."""
    left = 0
    while left < len(data):
        right = len(data) if left + size >= len(data) else data.find(b" ", left + size)
        right = len(data) if right < 0 else right
        yield data[left:right].split()
        left = right


def hashed(data: bytes, n: int, buckets: int, size: int = SEGMENT) -> Iterator[tuple[int, list[int]]]:
    """For each segment of a text: its number of words and the buckets of all runs of 1 to n words that end in it."""
    tail: list[list[int]] = [[] for _ in range(n - 1)]  # tail[k]: the checksum of the last run of k + 1 words before this segment, if there is one
    for words in segments(data.translate(TABLE), size):
        if not words:
            continue
        found = sums = list(map(zlib.crc32, words))
        spaced = (b" " + b"\n ".join(words)).split(b"\n")
        every = [[s % buckets for s in found]]
        for k in range(n - 1):
            # runs of k + 1 words that are followed by a word here: the one before the segment, then all but the segment's last
            seeds = tail[k] + sums[:-1]
            ahead = spaced[len(spaced) - len(seeds) :] if seeds else []
            tail[k] = sums[-1:] or tail[k]
            sums = list(map(zlib.crc32, ahead, seeds))
            every.append([s % buckets for s in sums])
        yield len(words), [b for some in every for b in some]


def texts_of(table, column: str) -> Iterator[bytes | None]:
    for x in table.column(column):
        value = x.as_buffer()
        yield value.to_pybytes() if value is not None else b""


def counts(docs: DataFrame, n: int = N, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, count) over all texts: a Counter for each task, added up by Spark."""

    def run(batches):
        total: Counter[int] = Counter()
        for table in batches:
            for part, _, _ in spans.chunks(table, "text"):
                for text in texts_of(part, "text"):
                    for _, found in hashed(text, n, buckets):
                        total.update(found)
        if total:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(total), pa.int64()), "count": pa.array(list(total.values()), pa.int64())})

    made = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, count long")
    return made.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS) -> list[int]:
    """What a feature of each bucket adds: the floored thousandth of the log ratio of smoothed shares, target against docs. One row a bucket."""
    both = counts(docs, n, buckets).withColumnRenamed("count", "s").join(counts(target, n, buckets).withColumnRenamed("count", "t"), "bucket", "full")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(both, "bucket", "left").na.fill(0, ["s", "t"])
    rows = every.collect()
    s_total, t_total = sum(r["s"] for r in rows), sum(r["t"] for r in rows)
    spark = docs.sparkSession
    s, t, size = F.col("s").cast("double"), F.col("t").cast("double"), float(buckets)
    ratio = (t + 1.0) * F.lit(s_total + size) / ((s + 1.0) * F.lit(t_total + size))
    made = spark.createDataFrame(rows, "bucket long, s long, t long").select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))
    out = [0] * buckets
    for r in made.collect():
        out[r["bucket"]] = r["gain"]
    return out


def weights(docs: DataFrame, gain: list[int], n: int = N) -> DataFrame:
    """Rows `SCORED`: the number of words and features of each row of docs and the floored mean of its features' gains, 0 without any."""

    def run(batches):
        value: Callable[[int], int] = gain.__getitem__
        for table in batches:
            for part, _, _ in spans.chunks(table, "text"):
                words, features, mean = [], [], []
                for text in texts_of(part, "text"):
                    count = size = total = 0
                    for more, found in hashed(text, n, len(gain)):
                        count, size, total = count + more, size + len(found), total + sum(map(value, found))
                    words.append(count)
                    features.append(size)
                    mean.append(total // size if size else 0)
                ids = part.column("doc_id")
                ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (words, features, mean))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORED)


def noise(seed: int) -> Column:
    """Thousandths of a Gumbel draw that belongs to the document's id; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Adds `rank` from 1 on to the given share of rows with enough words, by falling score, ties to the smaller doc_id; null for all others.

    A score occurs in few rows, as it holds the noise of the id; rows that repeat an id are ranked one after the other.
    """
    able = F.col("n_words") >= least_words
    numbered = scored.withColumn("__score", F.when(able, F.col("score")))
    # thousandths of logarithms of whole numbers: some ten thousand distinct scores at any size of the table
    per_score = numbered.filter(able).groupBy(F.col("score").alias("__of")).agg(F.count("*").alias("__n"))
    down = W.orderBy(F.col("__of").desc())
    per_score = per_score.select("__of", (F.sum("__n").over(down) - F.col("__n")).alias("__before"), F.floor(F.sum("__n").over(W.partitionBy()) * F.lit(percent) / 100).alias("__drawn"))
    drawn = numbered.join(F.broadcast(per_score.filter("__before < __drawn")), F.col("__score") == F.col("__of"), "left")
    inside = drawn.filter("__of IS NOT NULL")
    place = F.row_number().over(W.partitionBy("__score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight"))
    inside = inside.withColumn("__rank", F.col("__before") + place)
    inside = inside.withColumn("rank", F.when(F.col("__rank") <= F.col("__drawn"), F.col("__rank")))
    outside = drawn.filter("__of IS NULL").withColumn("rank", F.lit(None).cast("long"))
    columns = [*scored.columns, "rank"]
    return inside.select(*columns).unionByName(outside.select(*columns))


def resample(docs: DataFrame, target: DataFrame, n: int = N, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank), one for each row of docs (doc_id, text); rank is null where it isn't drawn.

    Words are runs of ASCII letters and digits and of all other bytes beyond ASCII, A-Z lower-cased. Features are all runs of 1 to n words,
    repeats counted; target (text) gives the shares aimed at. Null and empty texts have no features and weight 0; so has every row where
    docs is empty of words, and an empty target counts 0 everywhere. Rows that repeat count and are drawn like others. Other columns are
    ignored.
    """
    made = weights(docs, gains(docs, target, n, buckets), n)
    return ranked(cut_lineage(made.withColumn("score", F.col("weight") + noise(seed))), percent, least_words)
