"""The surface for callers' own code: encoders, Unicode form, group keys, rules, chunk tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.functions import text as T
from loomset.functions.chunk_rows import register
from loomset.functions.rules import RuleBook, joined
from loomset.operators.embed import chunk_table, term_vectors, term_weights
from loomset.operators.split import group_unique_batches

from . import sqltext as S
from .registry import query, table, texts
from .scalars import MAX, SQL_CHUNKS


def docs(spark, sf):
    return texts(spark, sf)


# term counts in 64 buckets, weighted by how few documents have a bucket
@query("embed_udf", f"""
WITH t AS (SELECT doc_id, unnest({S.tokens()}) AS t FROM documents), b AS (SELECT doc_id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 64 AS b, count(*) AS c FROM t GROUP BY ALL),
f AS (SELECT b, ln((SELECT count(*) + 1 FROM documents) / (count(*) + 1)) AS idf FROM b GROUP BY b),
w AS (SELECT doc_id, c * idf AS x FROM b JOIN f USING (b)),
n AS (SELECT doc_id, count(*) FILTER (x > 0) AS used, CASE WHEN sum(x * x) > 0 THEN max(x) / sqrt(sum(x * x)) ELSE 0 END AS top FROM w GROUP BY doc_id)
SELECT d.doc_id, 64::BIGINT AS dim, coalesce(used, 0) AS used, round(coalesce(top, 0), 4) AS top FROM documents d LEFT JOIN n USING (doc_id)""")
def embed_udf(spark, sf):
    rows = docs(spark, sf).select("doc_id", "text")
    made = term_vectors(rows, "text", term_weights(rows, "text"))
    return made.select(
        "doc_id", F.size("vec").cast("long").alias("dim"), F.size(F.filter("vec", lambda x: x > 0)).cast("long").alias("used"),
        F.round(F.array_max("vec").cast("double"), 4).alias("top"))


@query("nfkc_udf", "SELECT doc_id, text || ' 1 fi A' AS text FROM documents")
def nfkc_udf(spark, sf):
    return docs(spark, sf).select("doc_id", T.nfkc(F.concat("text", F.lit(" ① ﬁ Ａ"))).alias("text"))


@query("group_key_fn", """
WITH g AS (SELECT lang || '/' || source AS k, doc_id FROM documents), o AS (SELECT k, arg_min(doc_id, (md5('42|' || CAST(doc_id AS VARCHAR)), doc_id)) AS id FROM g GROUP BY k)
SELECT id, k AS group_key, CAST(floor((row_number() OVER (ORDER BY md5('42|' || k), k) - 1) / 16) AS BIGINT) AS batch FROM o""")
def group_key_fn(spark, sf):
    return group_unique_batches(docs(spark, sf), "doc_id", F.concat_ws("/", "lang", "source"), 16)


@query("rule_registry", f"""
SELECT doc_id, array_to_string(list_filter([CASE WHEN NOT {S.is_valid_text()} THEN 'invalid' END, CASE WHEN {S.est_tokens()} > 512 THEN 'too_long' END,
  CASE WHEN contains(text, '@') THEN 'contact' END, CASE WHEN lang <> 'en' AND n_chars < 200 THEN 'short_foreign' END], lambda x: x IS NOT NULL), '|') AS issues FROM documents""")
def rule_registry(spark, sf):
    text = F.col("text")
    book = RuleBook([("invalid", ~T.is_valid_text(text)), ("too_long", T.est_tokens_words(text) > 512)])
    book.register("contact", text.contains("@")).register("short_foreign", (F.col("lang") != "en") & (F.col("n_chars") < 200))
    return docs(spark, sf).select("doc_id", joined(book.issues()).alias("issues"))


@query("chunk_udtf", SQL_CHUNKS)
def chunk_udtf(spark, sf):
    register(spark, "chunk_text")
    return spark.sql(
        "SELECT d.doc_id, c.chunk_no, c.chunk FROM {docs} d, LATERAL chunk_text(d.text, {most}) c", docs=docs(spark, sf), most=MAX)


@query("chunk_rows", SQL_CHUNKS)
def chunk_rows(spark, sf):
    return chunk_table(docs(spark, sf), "text", ["doc_id"], MAX)
