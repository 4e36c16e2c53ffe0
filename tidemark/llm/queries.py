"""The registered queries of the training-data operators: name -> (query, SQL twin or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import latent, mixing, near_dups, negatives, pages, pieces, quality, ranking, secrets, sharding, suffixes, tokens, vectors
from tidemark.llm.common import table
from tidemark.session import fresh_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return keep


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this machine and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_suffix_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffixes.without_repeats(table(spark, folder, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0), lambda s, x: s + x["end"] - x["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_pu_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels", "doc_id", "quality"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, hash(unnest(g)) AS x FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, least) AS (SELECT doc_id, doc_id FROM s UNION SELECT b, least FROM reach JOIN ways ON node = a WHERE least < b),
found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(g) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN found ON doc_id = node"""


@register("op3_super_minhash", NEAR_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


@register("op5_main_text")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract_pages(table(spark, folder, "pages", "page_id", "url", "html"))


@register("op6_latent_leaks")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return latent.contaminated(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(node, least) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT b, least FROM reach JOIN links ON node = a WHERE least < b),
found AS (SELECT node, min(least) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN found ON vec_id = node"""


@register("op7_vector_links", VECTOR_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.vector_groups(table(spark, folder, "embeddings", "vec_id", "embedding", "label"))


@register("op4_wavelet_tokens")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    path = fresh_folder(spark, "token-shards")
    tokens.write_token_shards(docs, path, vocabulary("byte_bpe_50k.json"), end_id=2, added=True)
    return tokens.token_checksums(spark, path)


@register("op8_sentence_pieces")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    done = pieces.encode_decode(docs, vocabulary("piece_bpe_32k.model"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op9_secrets")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = secrets.find_secrets(docs)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


@register("op10_byte_shards")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    placed = sharding.byte_shards(docs, 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10"""


@register("op11_rtree_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    vectors_ = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors_, F.col("vec_id") % 100 == 0, label)


@register("op12_entropy_mix")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents", "doc_id", "text", "source"))


RANKING_SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, c WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
s AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (doc_id), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 20"""


@register("op13_term_pipeline", RANKING_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_documents(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))
