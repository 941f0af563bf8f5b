"""The subpackage's operators bound to the test tables: name -> query, name -> SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, contamination, importance, language, licenses, main_text, neighbours, packing, quality, repeats, shingle_join, token_counts
from .shared import importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op1_license_scan")
def license_scan(table):
    """Licence notices and expressions of every document."""
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return licenses.scan(table("documents")).select(*columns, "n_notices", "expressions")


@query("op2_language_id")
def language_id(table):
    """The language of every document, by dictionaries of the documents whose crc32(doc_id) modulo 3 isn't 1."""
    documents = table("documents")
    made = language.learn(documents.filter(~held_out(3, 1)).select("doc_id", "text", "lang"))
    return language.identify(documents.select("doc_id", "text"), made).select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score", "rejected", "runner_up")


@query("op3_shingle_join")
def near_duplicates(table):
    """Each document's class of near duplicates (five-word shingles, similarity 0.8) and its number of links."""
    return shingle_join.links(table("documents"))


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, i, list_slice(w, i, i + 12) AS x FROM words, unnest(range(1, len(w) - 11)) AS t(i)
), firsts AS (
  SELECT x, min(doc_id) AS least FROM starts GROUP BY x
), gone AS (
  SELECT DISTINCT doc_id, p FROM (SELECT s.doc_id, unnest(range(s.i, s.i + 13)) AS p FROM starts s JOIN firsts f USING (x) WHERE f.least < s.doc_id)
), parts AS (
  SELECT doc_id, i, w[i] AS v FROM words, unnest(range(1, len(w) + 1)) AS t(i)
), kept AS (
  SELECT p.doc_id, string_agg(p.v, ' ' ORDER BY p.i) AS k, count(*) AS n FROM parts p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.p GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.k, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
"""


@query("op4_substring_dedup", OP4_SQL)
def substring_dedup(table):
    """Words covered by a 13-word window that a document with a smaller id also has are removed."""
    cut = repeats.remove_repeats(table("documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def fitted_quality(documents: DataFrame, labels: DataFrame) -> quality.Network:
    """The network fitted on labelled rows whose crc32(doc_id) is no multiple of 5."""
    seen = labels.filter(~held_out(5, 0)).select("doc_id", F.col("quality").alias("label"))
    return quality.train(documents.select("doc_id", "text").join(seen, "doc_id"))


def held_out(folds: int, fold: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


@query("op5_quality")
def text_quality(table):
    """The network's score of every document; 1 is predicted from 0.3 on."""
    documents = table("documents")
    scored = quality.score(documents.select("doc_id", "text"), fitted_quality(documents, table("labels")))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op6_token_counts")
def edited_token_counts(table):
    """Token counts of every document before and after three edits made from its own text: the middle upper-cased, a word's length deleted
    at a place given by the doc_id, a line inserted."""
    n = F.char_length("text")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(n, F.lit(1))).cast("long")
    middle = F.floor(n / 2)
    edit = lambda start, length, insert: F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), insert.alias("insert"))
    edits = F.array(
        edit(middle, F.lit(40), F.upper(F.substring("text", (middle + 1).cast("int"), F.lit(40)))),
        edit(place, F.lit(7), F.lit("")),
        edit(F.floor(place / 2), F.lit(0), F.concat(F.lit(" revised,\n"), F.substring("text", 1, 30))),
    )
    documents = table("documents").select("doc_id", "text", F.when(F.col("text").isNotNull(), edits).alias("edits"))
    counted = token_counts.recount(documents, "edits", packing.tokenizer_path("byte_bpe_50k.json"), encode_special_tokens=False)
    return counted.select("doc_id", "n_tokens", "n_tokens_after", "n_chars", "n_chars_after", "n_edits", "n_encoded_chars")


OP7_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op7_nearest_neighbours", OP7_SQL)
def nearest_neighbours(table):
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return neighbours.nearest(table("embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op8_packing")
def sequence_packing(table):
    """Pieces of documents in sequences of 2,048 ids."""
    made = packing.pack(table("documents"), packing.tokenizer_path("byte_bpe_50k.json"), encode_special_tokens=False)
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_decontamination")
def decontamination(table):
    """Benchmark items that documents hold, with the place of the best window and its similarity."""
    return contamination.leaks(table("documents"), table("benchmark"))


@query("op10_main_text")
def page_text(table):
    """The main text of every page."""
    return main_text.extract(table("pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")


OP11_SQL = r"""
WITH table16 AS (
  SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), texts AS (
  SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM texts
), held AS (
  SELECT side, r, f, count(*) AS n FROM features GROUP BY ALL
), hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(0, strlen(f)), lambda i: [instr('0123456789ABCDEF', hex(encode(f))[2 * i + 2]) - 1, instr('0123456789ABCDEF', hex(encode(f))[2 * i + 1]) - 1]))), lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM held), table16
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS t FROM held JOIN hashed USING (f) GROUP BY bucket
), totals AS (
  SELECT sum(s)::BIGINT AS s_total, sum(t)::BIGINT AS t_total FROM counts
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_total + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_total + 10000)::DOUBLE)))::BIGINT AS g FROM counts, totals
), sums AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS total FROM held JOIN hashed USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r
), scored AS (
  SELECT id AS doc_id, r, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(CASE WHEN total < 0 THEN -((-total + n_features - 1) // n_features) ELSE total // n_features END, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || coalesce(id::VARCHAR, ''))[1:8])::BIGINT AS h
  FROM texts LEFT JOIN sums USING (r) WHERE side = 'd'
), final AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score, n_words >= 20 AS able FROM scored
), ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM final WHERE able
)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank FROM final LEFT JOIN ranked USING (r)
"""


@query("op11_importance_resampling", OP11_SQL)
def importance_resampling(table):
    """A quarter of the documents with 20 words or more, drawn by likeness to the benchmark."""
    return importance.resample(table("documents"), table("benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_tokenizer_alignment")
def tokenizer_alignment(table):
    """Groups and links of two tokenizers' ids of every document, with the corpus-wide counts of the linked pairs."""
    return alignment.align(table("documents"), packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("piece_bpe_32k.model"))


#: a text that looks like marks of several templates
CONTROL_TEXT = r"\### Assistant: </turn> ok"

OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), placed AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w IS DISTINCT FROM role AS opens FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), written AS (
  SELECT *, length(regexp_replace(text, '<(\\*)(turn>|text>|next>|/turn>)', '<\\\1\2', 'g')) + CASE WHEN opens THEN 19 + length(regexp_replace(role, '<(\\*)(turn>|text>|next>|/turn>)', '<\\\1\2', 'g')) ELSE 6 END AS n FROM placed
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


@query("op13_chat_format", OP13_SQL)
def chat_format(table):
    """Digests of every conversation's turns and learned text, read back from its formatted form."""
    turns = table("conversations").select("conv_id", "turn", "role", "text")
    more = turns.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    made = chat.format_turns(turns.unionByName(more))
    made = made.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_learned(F.col("pieces")).alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
