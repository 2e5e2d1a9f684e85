"""The registered queries of this package, one for each operator, and their oracle SQL.

Each applies its operator to the whole of its tables and derives the asked columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retail_mart.llm import decontam, divergence, langid, lm_score, mixing, order_minhash, packing, quotes, secrets, tokens, topk, warc, word_runs
from retail_mart.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.fit(documents, ~langid.held_out())
    return langid.predict(documents.select("doc_id", "text"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
    return lm_score.score(table(spark, sf_dir, "documents"), good)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """Mail as it would be sent: each row above the turn before it, quoted,
    and the one before that, quoted twice; (msg_id, scope, ord, text). Rows
    of one (conv_id, turn) are messages of their own; later turns quote the
    first of them by text."""
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("text"))
    one = conversations.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text")).withColumn("place", place)
    first = one.filter("place = 1")

    def before(k: int) -> DataFrame:
        return first.select(F.col("conv_id").alias(f"c{k}"), (F.col("turn") + k).alias(f"t{k}"), F.col("text").alias(f"text{k}"))

    def quoted(text: str, marks: str):
        return F.concat(F.lit("\n" + marks), F.regexp_replace(text, "\n", "\n" + marks))

    j = one
    for k in (1, 2):
        b = before(k)
        j = j.join(b, j["conv_id"].eqNullSafe(b[f"c{k}"]) & (j["turn"] == b[f"t{k}"]), "left")
    body = F.concat("text", F.coalesce(F.concat(F.lit("\n\nOn an earlier day they wrote:"), quoted("text1", "> ")), F.lit("")),
                    F.coalesce(quoted("text2", ">> "), F.lit("")))
    name = F.concat_ws("/", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.col("place").cast("string"))
    return j.select(name.alias("msg_id"), F.col("conv_id").alias("scope"), F.col("turn").alias("ord"), body.alias("text"))


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt from quotes: the replies of every turn, sent as mail."""
    c = quotes.conversations(quoting_messages(table(spark, sf_dir, "conversations")))
    part = lambda x, k: F.try_element_at(F.split(x, "/"), F.lit(k)).try_cast("long")
    return c.select(part("msg_id", 1).alias("conv_id"), part("msg_id", 2).alias("turn"), part("reply_to", 2).alias("reply_to_turn"),
                    part("root", 2).alias("root_turn"), "depth", "text")


def periodic_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text): with h the crc32 of the id in decimal, a text of h % 10 = 0 goes round its p words from word a on; others stay."""
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, g = F.size(words).cast("long"), F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 10)
    a = F.when(n > 0, g % n)
    p = F.lit(1).cast("long") + F.floor((n - a) / (g % 8 + 3))
    part = lambda x, k, m: F.slice(x, k.cast("int"), m.cast("int"))
    turns = F.flatten(F.array_repeat(part(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    round_ = F.array_join(part(F.concat(part(words, F.lit(1), a), turns), F.lit(1), n), " ")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return documents.select("doc_id", F.when(chosen & (n > 0), round_).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = word_runs.periodic_runs(periodic_texts(table(spark, sf_dir, "documents")))
    line = lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))
    top = F.col("densest")
    return r.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
                    top["period"].alias("period"), F.floor(top["length"] * 1000 / top["period"]).alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return p.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.Audit(table(spark, sf_dir, "documents")).report()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    "op1_mixing": op1_mixing, "op2_topk": op2_topk, "op3_near_dedup": op3_near_dedup, "op4_warc": op4_warc, "op5_tokens": op5_tokens,
    "op6_langid": op6_langid, "op7_lm_score": op7_lm_score, "op8_secrets": op8_secrets, "op9_decontamination": op9_decontamination,
    "op10_quotes": op10_quotes, "op11_periodic_runs": op11_periodic_runs,
    "op12_packing": op12_packing, "op13_divergence": op13_divergence, "pipeline": pipeline,
}

# The others have no SQL form: SHA-1 in base32, xxHash64, tokenizers, trees and alignments are not in the SQL engine;
# tests/llm holds them against brute force.
LLM_ORACLE = {
    "op2_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_quotes": """
WITH t AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM (SELECT DISTINCT conv_id, turn FROM conversations)
), p AS (
  SELECT t.*, coalesce(b.turn, d.turn) AS reply_to_turn
  FROM t LEFT JOIN t b ON b.conv_id = t.conv_id AND b.turn = t.turn - 1
  LEFT JOIN t d ON d.conv_id = t.conv_id AND d.turn = t.turn - 2
), r AS (
  SELECT *, max(CASE WHEN reply_to_turn IS NULL THEN turn END) OVER w AS root_turn,
    place - max(CASE WHEN reply_to_turn IS NULL THEN place END) OVER w AS depth
  FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)
)
SELECT r.conv_id, r.turn, reply_to_turn, root_turn, depth, trim(c.text, e' \\n\\t\\r') AS text
FROM conversations c JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.turn IS NOT DISTINCT FROM c.turn
""",
    "op13_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), u AS (SELECT id, lang, source, unnest(terms) AS term FROM d
), c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM u GROUP BY ALL
), k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 30
), l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang
), kc AS (SELECT c.lang, c.source, c.term, c.n FROM c JOIN k ON k.lang = c.lang AND k.term = c.term
), g AS (
  SELECT g.lang, g.source, coalesce(sum(kc.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN kc ON kc.lang = g.lang AND kc.source = g.source GROUP BY g.lang, g.source
), s AS (
  SELECT g.lang, g.source, k.term, coalesce(kc.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(kc.n, 0) + 5)) // (g.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
  FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
  LEFT JOIN kc ON kc.lang = g.lang AND kc.source = g.source AND kc.term = k.term
), x AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM s a JOIN s b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM s WHERE n > 0 AND p > q
), o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM o WHERE part = 'pair' OR rank <= 50
""",
}
