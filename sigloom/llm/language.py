"""Language identification by compression.

Each language has a zstandard dictionary of raw content, put together from a bounded sample of its labelled texts. A text is
lower-cased and compressed with every dictionary, in pieces of 8 kB over its whole length; the language whose dictionary gives the smallest sum
is chosen. If the runner-up is nearly as small the text is marked as rejected; the best guess stays in its column.
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import spans

SAMPLE = 120
SHARE = 1600
DICTIONARY = 96 << 10
PIECE = 8 << 10
LEVEL = 6
MARGIN = 0.01
LANGUAGES = 512
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
NAMED = "doc_id long, lang_pred string, score double, rejected boolean, runner_up string, sizes map<string,long>"


def learn(docs: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """A dictionary for each non-null value of lang in docs (doc_id, text, lang).

    From each language apart the `sample` rows with the smallest hashes of id and text are taken, `SHARE` characters from the middle of each, up
    to 96 kB; all rows take part in the choice, rows that repeat as one. Null and empty texts are left out. More than `LANGUAGES` languages are
    refused.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    mark: Column = F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 40))
    marked = rows.groupBy("lang").agg(F.approx_count_distinct(mark).alias("count"))
    count = {r["lang"]: r["count"] for r in marked.orderBy("lang").limit(LANGUAGES + 1).collect()}
    if len(count) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not count:
        return {}
    # about three times the sample passes, so that few rows are sorted
    bound = F.create_map(*[F.lit(x) for lang, n in count.items() for x in (lang, int(min(1.0, (3.0 * sample + 40) / max(1, n)) * (1 << 40)))])
    middle = F.expr(f"substring(text, greatest(1, cast(length(text) / 2 as int) - {SHARE // 2}), {SHARE})")
    few = rows.filter(mark < bound[F.col("lang")]).groupBy("lang", mark.alias("mark")).agg(F.min(middle).alias("part"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("mark"))
    parts: dict[str, list] = {}
    for r in few.withColumn("i", first).filter(F.col("i") <= sample).orderBy("lang", "i").collect():
        parts.setdefault(r["lang"], []).append(r["part"].lower().encode())
    made = {}
    for lang, own in sorted(parts.items()):
        # the content nearest to the text is the cheapest to refer to, so the first rows come last
        made[lang] = b"\n".join(own[:sample][::-1])[-DICTIONARY:]
    return made


class Coders:
    """Compressors by language."""

    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        self.names = [k for k, _ in dictionaries]
        self.coders = []
        for _, content in dictionaries:
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, raw: bytes) -> list[int]:
        pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.coders]

    def name(self, text: str | None) -> tuple:
        """A text's row: language, score, whether rejected, runner-up, sizes."""
        if not text or not self.names or not LETTER.search(text):
            return UNKNOWN, 0.0, True, None, {}
        raw = text.lower().encode()
        sizes = self.sizes(raw)
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], self.names[k]))
        best, next_ = order[0], order[1] if len(order) > 1 else None
        told = dict(zip(self.names, sizes, strict=True))
        if next_ is None:
            return self.names[best], 1.0, False, None, told
        gap = sizes[next_] - sizes[best]
        margin = gap / max(1, sizes[next_])
        score = 1 / (1 + math.exp(-min(40.0, 0.35 * gap))) * 2 - 1
        return self.names[best], max(0.0, min(1.0, 0.5 + 0.5 * score)), margin < MARGIN or gap < 2, self.names[next_], told


@lru_cache(maxsize=2)
def coders(dictionaries: tuple[tuple[str, bytes], ...]) -> Coders:
    return Coders(dictionaries)


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, lang_pred, score (0 to 1), rejected, runner_up, sizes (bytes by language).

    lang_pred is a language of the dictionaries, or `und` (score 0) for a null text, one without a letter, or without any dictionary;
    ties go to the first name. `rejected` marks a margin below 1 % or two bytes. Whole texts are read; rows that repeat or have a
    null doc_id are named like others; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(dictionaries.items())))

    def run(batches):
        made = coders(shared.value)
        for batch in batches:
            for part, _, _ in spans.chunks(batch, "text"):
                columns = list(zip(*[made.name(t) for t in part.column("text").to_pylist()], strict=True))
                columns[4] = [list(x.items()) for x in columns[4]]
                kinds = [pa.string(), pa.float64(), pa.bool_(), pa.string(), pa.map_(pa.string(), pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "lang_pred", "score", "rejected", "runner_up", "sizes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, NAMED)
