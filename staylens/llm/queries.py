"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex16(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, at most 2 differing bits."""
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex16("fp").alias("fingerprint"), "component_id")


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    from .pack import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of templates that recur across documents."""
    from .linededup import drop_repeated_lines

    found = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


SQL["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, g.pos AS pos, string_split(text, chr(10))[g.pos + 1] AS line
  FROM documents, generate_series(0, len(string_split(text, chr(10))) - 1) AS g(pos)
), tokens AS (
  SELECT doc_id, pos,
         list_transform(list_filter(regexp_split_to_array(line, '[ \t\r\f]+'), lambda x: x <> ''),
                        lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS t
  FROM lines
), judged AS (
  SELECT doc_id, pos, t, len(t) AS n FROM tokens
  WHERE len(t) >= 3 AND 2 * len(list_filter(t, lambda x: x = '<*>')) <= len(t)
), templates AS (
  SELECT doc_id, pos, n, t AS template FROM judged
  UNION ALL
  SELECT doc_id, pos, n,
         list_concat(['#' || n || '#' || g.g], t[1:3 + (n - 3) * g.g // 5], ['<?>'], t[4 + (n - 3) * (g.g + 1) // 5:]) AS template
  FROM judged, generate_series(0, 4) AS g(g) WHERE n >= 10
), recurring AS (
  SELECT template, min((doc_id, pos)) AS first
  FROM templates GROUP BY template
  HAVING count(DISTINCT doc_id) >= CASE WHEN min(n) >= 8 THEN 2 ELSE 10 END
), dropped AS (
  SELECT DISTINCT doc_id, pos FROM templates JOIN recurring USING (template) WHERE (doc_id, pos) <> first
)
SELECT d.doc_id,
       CASE WHEN count(x.pos) = 0 THEN any_value(d.text)
            ELSE coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE x.pos IS NULL), '') END AS text,
       count(l.pos)::INTEGER AS n_lines, count(x.pos)::INTEGER AS n_dropped
FROM documents d LEFT JOIN lines l ON l.doc_id = d.doc_id
LEFT JOIN dropped x ON x.doc_id = l.doc_id AND x.pos = l.pos
GROUP BY d.doc_id
"""


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains, with the passage."""
    from .decontaminate import contaminated

    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "item_id", F.col("met").alias("n_windows_met"), F.col("windows").alias("n_windows"),
        F.col("slots").alias("n_slots"), "start", "end",
    )


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fifth."""
    from . import toxicity as T

    docs = table(spark, sf_dir, "documents")
    model = T.train(T.training_rows(docs, table(spark, sf_dir, "labels")))
    return T.score(docs, model).select(
        F.col("id").alias("doc_id"), T.held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.regexp_replace("unit", r"^\^|\$$", "").alias("worst_unit"),
    )


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings at cosine 0.9."""
    from .embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


SQL["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n ON n.a = e.vec_id
"""


# The rules of the URL filter query.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page: the longest rule's, else the trees'."""
    from .urls import judge

    found = judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "block_score")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from two thirds of them."""
    from . import langid as G

    docs = table(spark, sf_dir, "documents")
    languages = G.prototypes(G.training_rows(docs))
    return G.identify(docs, languages).select(F.col("id").alias("doc_id"), G.held_out("id").alias("held_out"), "lang_pred", "score")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label quality of all documents: votes, posterior, score and decision."""
    from . import quality as Q

    docs = table(spark, sf_dir, "documents")
    return Q.classify(docs, Q.train(docs)).select(F.col("id").alias("doc_id"), "votes", "posterior", "score", (F.col("score") >= 0.5).alias("keep"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of all documents; target: documents labelled of quality."""
    from .lmscore import score

    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score(table(spark, sf_dir, "documents"), good).withColumnRenamed("id", "doc_id")


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of all documents, as digests of the output and of the text
    restored from it."""
    from .fim import fill_in_middle, restored

    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


SQL["op11_fill_in_middle"] = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS x,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), hashed AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
  FROM units
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM parts
"""


@query
def op13_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage to its rows."""
    from .conversations import damage, diagnose

    found = diagnose(damage(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back through the capture index."""
    from .warc import read, write

    pages = table(spark, sf_dir, "pages")
    found = read(write(pages), pages, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op12_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM d
"""
