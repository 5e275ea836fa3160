"""Windows, splits, sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.functions import text as T
from loomset.operators import dedup as D
from loomset.operators.checks import clean_valid
from loomset.operators import ranking as RK
from loomset.operators import runs as RU
from loomset.operators import sets as SE
from loomset.operators import split as SP
from loomset.operators import stats as ST
from loomset.session import written_table
from loomset.sources.writers import number_batches

from . import sqltext as S
from .registry import query, table, texts
from .views import doc_labels, samples, split_of


def docs(spark, sf):
    return table(spark, sf, "documents")


@query("seeded_shuffle", """
SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) AS rank FROM documents""")
def seeded_shuffle(spark, sf):
    return RK.seeded_rank(docs(spark, sf).select("doc_id"), "doc_id")


# every other source has no template hint
@query("group_key", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'template_' || source ELSE 'industry_client_' || substr(sha1(lang || '|' || source), 1, 8) END AS group_key FROM documents""")
def group_key(spark, sf):
    hint = F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return docs(spark, sf).select("doc_id", SP.group_key(hint, F.col("lang"), F.col("source")).alias("group_key"))


def sql_group_split(rows="documents"):
    return f"""
gc AS (SELECT source, lang, count(*) AS c FROM {rows} GROUP BY ALL),
gm AS (SELECT source, CAST(sum(c) AS BIGINT) AS size, arg_min(lang, (-c, lang)) AS lang FROM gc GROUP BY source),
gr AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY lang ORDER BY md5('42|' || source), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
       sum(size) OVER (PARTITION BY lang) AS total FROM gm),
gt AS (SELECT *, before < floor(total::DOUBLE * 0.7) AS in_train FROM gr),
gs AS (SELECT source, lang, size, CASE WHEN in_train THEN 'train' WHEN before - coalesce(sum(CASE WHEN in_train THEN size ELSE 0 END) OVER (PARTITION BY lang), 0) < floor(total::DOUBLE * 0.15) THEN 'val' ELSE 'test' END AS split FROM gt)"""


@query("group_stratified_split", f"WITH {sql_group_split()} SELECT source, lang, size, split FROM gs")
def group_stratified_split(spark, sf):
    return SP.group_stratified_split(docs(spark, sf), "source", "lang")


# the flagship: clean, validate, keep the best copy, split by source, count
@query("curated_split", f"""
WITH {S.SAMPLES}, cleaned AS (SELECT doc_id, lang, source, coherence, is_ood, {S.clean_text()} AS text FROM samples),
valid AS (SELECT * FROM cleaned WHERE {S.is_valid_text()}),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY coherence DESC, is_ood, CAST(doc_id AS VARCHAR) DESC) AS rn FROM valid) WHERE rn = 1),
{sql_group_split('kept')},
counted AS (SELECT s.split, k.lang, count(*) AS n FROM kept k JOIN gs s USING (source) GROUP BY ALL)
SELECT split, lang, n, round(n / (SELECT sum(n) FROM counted), 6)::DOUBLE AS share FROM counted""")
def curated_split(spark, sf):
    # texts stay in the scan stage; only digests and keys are shuffled
    cleaned = clean_valid(samples(spark, sf).drop("n_chars"), with_text=False)
    kept = D.survivors_by_digest(cleaned, "doc_id", "digest", "coherence", "is_ood")
    # read three times below: written once, so the texts are cleaned once
    small = written_table(kept.select("source", "lang"), "kept")
    groups = SP.group_stratified_split(small, "source", "lang").select("source", "split")
    counted = small.join(groups, "source").groupBy("split", "lang").agg(F.count("*").alias("n"))
    total = small.agg(F.count("*")).scalar()
    return counted.withColumn("share", F.round(F.col("n") / total, 6))


@query("profile_stratified_split", """
WITH rc AS (SELECT conv_id, role, count(*) AS c FROM conversations GROUP BY ALL),
p AS (SELECT conv_id, array_to_string(list_sort(list(role || ':' || printf('%.2f', round(c / total, 2)))), '|') AS profile FROM (SELECT *, sum(c) OVER (PARTITION BY conv_id) AS total FROM rc) GROUP BY conv_id),
r AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY md5('42|' || CAST(conv_id AS VARCHAR)), conv_id) - 1 AS place, count(*) OVER (PARTITION BY profile)::DOUBLE AS n FROM p)
SELECT conv_id, profile, CASE WHEN place < floor(n * 0.7) THEN 'train' WHEN place < floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM r""")
def profile_stratified_split(spark, sf):
    profiles = ST.label_profile(table(spark, sf, "conversations"), "conv_id", "role")
    return SP.profile_stratified_split(profiles, "conv_id", "profile")


@query("small_group_split", f"""
WITH {S.DOC_LABELS}, c AS (SELECT doc_id, array_to_string(list_sort(labels), '|') AS combo FROM doc_labels),
r AS (SELECT *, row_number() OVER (PARTITION BY combo ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place, count(*) OVER (PARTITION BY combo) AS n FROM c),
a AS (SELECT *, least(greatest(1, floor(n::DOUBLE * 0.7)), n - 2) AS a, greatest(1, floor(n::DOUBLE * 0.15)) AS b0 FROM r)
SELECT doc_id, combo, CASE WHEN n = 1 THEN 'train' WHEN n = 2 THEN CASE WHEN place = 0 THEN 'train' ELSE 'val' END
  WHEN place < a THEN 'train' WHEN place < a + least(b0, n - 1 - a) THEN 'val' ELSE 'test' END AS split FROM a""")
def small_group_split(spark, sf):
    rows = doc_labels(spark, sf).select("doc_id", ST.combo(F.col("labels")).alias("combo"))
    return SP.small_group_split(rows, "doc_id", "combo")


@query("train_test_split", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM documents""")
def train_test_split(spark, sf):
    return SP.train_test_split(docs(spark, sf).select("doc_id"), "doc_id", 0.2)


@query("stratified_review_sample", f"""
WITH {S.SAMPLES}, h AS (SELECT *, md5('42|' || CAST(doc_id AS VARCHAR)) AS h FROM samples),
c AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS r FROM h)
SELECT doc_id, lang, 'class' AS why FROM c WHERE r <= 100 // (SELECT count(DISTINCT lang) FROM h)
UNION ALL (SELECT doc_id, lang, 'edge' FROM h WHERE n_chars < 100 ORDER BY h, doc_id LIMIT 10)
UNION ALL (SELECT doc_id, lang, 'ood' FROM h WHERE is_ood ORDER BY h, doc_id LIMIT 10)""")
def stratified_review_sample(spark, sf):
    return SP.review_sample(samples(spark, sf), "doc_id", "lang", F.col("n_chars") < 100, F.col("is_ood"))


SQL_BATCHES = """
WITH o AS (SELECT conv_id AS k, arg_min(conv_id * 1000 + turn, (md5('42|' || CAST(conv_id * 1000 + turn AS VARCHAR)), conv_id * 1000 + turn)) AS id FROM conversations GROUP BY conv_id)
SELECT id, CAST(k AS VARCHAR) AS group_key, CAST(floor((row_number() OVER (ORDER BY md5('42|' || CAST(k AS VARCHAR)), CAST(k AS VARCHAR)) - 1) / 8) AS BIGINT) AS batch FROM o"""


@query("group_unique_batches", SQL_BATCHES)
def group_unique_batches(spark, sf):
    turns = table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return SP.group_unique_batches(turns, "id", "conv_id", 8)


@query("batch_numbering", """
SELECT o_orderkey, rn AS sample_no, (rn - 1) // 500 + 1 AS batch_id FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)""")
def batch_numbering(spark, sf):
    return number_batches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 500)


@query("weighted_bucket", """
WITH u AS (SELECT doc_id, CAST('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM documents)
SELECT doc_id, CASE WHEN u <= 0.2 THEN 'minimal' WHEN u <= 0.6 THEN 'moderate' WHEN u <= 0.9 THEN 'complex' ELSE 'comprehensive' END AS level FROM u""")
def weighted_bucket(spark, sf):
    weights = [("minimal", 0.2), ("moderate", 0.4), ("complex", 0.3), ("comprehensive", 0.1)]
    return docs(spark, sf).select("doc_id", SP.weighted_bucket(SP.unit_of(F.col("doc_id")), weights).alias("level"))


@query("rolling_latency", """
SELECT event_id, user_id, round(CASE WHEN row_number() OVER w >= 10 THEN avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) ELSE 0 END, 6) AS recent_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def rolling_latency(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    made = ST.rolling_mean(events, "user_id", ["ts", "event_id"], "value", F.date_trunc("minute", "ts"), 10)
    return made.select("event_id", "user_id", F.round("recent_mean", 6).alias("recent_mean"))


@query("top_k_counts", f"""
SELECT token, count(*) AS n FROM (SELECT unnest({S.tokens()}) AS token FROM documents) GROUP BY token ORDER BY n DESC, token LIMIT 20""")
def top_k_counts(spark, sf):
    return RK.top_k_counts(texts(spark, sf).select(F.explode(T.tokens(F.col("text"))).alias("token")), "token", 20)


# runs = users, an odd last event leaves the run unfinished
@query("sort_runs", """
WITH r AS (SELECT user_id AS id, min(ts) AS startedAt, CASE WHEN max(event_id) % 2 = 0 THEN max(ts) END AS finishedAt FROM events GROUP BY user_id)
SELECT id, strftime(finishedAt, '%Y-%m-%d %H:%M:%S') AS finished, row_number() OVER (ORDER BY coalesce(finishedAt, TIMESTAMP '1970-01-01'), id) AS position FROM r""")
def sort_runs(spark, sf):
    runs = table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.min("ts").alias("startedAt"), F.when(F.max("event_id") % 2 == 0, F.max("ts")).alias("finishedAt"))
    order = RU.sort_order(runs, "finishedAt:asc", RU.RUN_SORTS, "id")
    placed = RK.dense_numbers(runs, order, "position")
    return placed.select("id", F.date_format("finishedAt", "yyyy-MM-dd HH:mm:ss").alias("finished"), "position").orderBy("position")


@query("page_logs", """
WITH l AS (SELECT event_id, event_type, user_id FROM events WHERE event_type = 'error' AND contains(lower(props), '4')), t AS (SELECT count(*) AS total FROM l)
SELECT event_id, user_id, total, CASE WHEN 300 < total THEN 300::BIGINT END AS next_offset FROM (SELECT * FROM l ORDER BY event_id OFFSET 200 LIMIT 100), t""")
def page_logs(spark, sf):
    logs = table(spark, sf, "events").where("event_type = 'error'").where(F.lower("props").contains("4"))
    return RK.page(logs.select("event_id", "user_id"), [F.col("event_id")], 200, 100)


@query("page_logs_keyset", """
SELECT event_id, event_type FROM events WHERE (ts, event_id) > (SELECT (ts, event_id) FROM events WHERE event_id = 5000) ORDER BY ts, event_id LIMIT 100""")
def page_logs_keyset(spark, sf):
    events = table(spark, sf, "events")
    last = events.where("event_id = 5000")
    found = RK.page_after(events, "ts", "event_id", last.agg(F.max("ts")).scalar(), F.lit(5000), 100)
    return found.select("event_id", "event_type")


@query("recent_n", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 25")
def recent_n(spark, sf):
    return RK.recent_n(table(spark, sf, "events"), "ts", "event_id", 25).select("event_id", "event_type")


@query("top_n_per_group", """
SELECT user_id, event_id, value, rank FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events) WHERE rank <= 3""")
def top_n_per_group(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "value")
    return RK.top_n_per_group(rows, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3)


@query("union_sources", """
SELECT 'documents' AS origin, doc_id AS id, lang, NULL AS role, length(text) AS chars FROM documents
UNION ALL SELECT 'conversations', conv_id * 1000 + turn, NULL, role, length(text) FROM conversations
UNION ALL SELECT 'benchmark', item_id, NULL, NULL, length(text) FROM benchmark""")
def union_sources(spark, sf):
    def part(name, id_, *extra):
        return table(spark, sf, name).select(
            F.lit(name).alias("origin"), id_.alias("id"), *extra, F.length("text").cast("long").alias("chars"))

    return SE.union_sources(
        part("documents", F.col("doc_id"), "lang"),
        part("conversations", F.col("conv_id") * 1000 + F.col("turn"), "role"), part("benchmark", F.col("item_id")))


# by document the split is sound, by source it leaks
@query("split_leak_check", f"""
SELECT 'source' AS grouping, source AS key, count(DISTINCT {S.split_of()}) AS splits FROM documents GROUP BY source HAVING splits > 1
UNION ALL SELECT 'doc_id', CAST(doc_id AS VARCHAR), count(DISTINCT {S.split_of()}) FROM documents GROUP BY doc_id HAVING count(DISTINCT {S.split_of()}) > 1""")
def split_leak_check(spark, sf):
    rows = docs(spark, sf).withColumn("split", split_of(F.col("doc_id")))
    parts = [
        SP.split_leaks(rows, group).select(F.lit(group).alias("grouping"), F.col(group).cast("string").alias("key"), F.col("splits").cast("long").alias("splits"))
        for group in ("source", "doc_id")
    ]
    return parts[0].unionByName(parts[1])


@query("set_difference", f"""
WITH h AS (SELECT DISTINCT unnest({S.tokens()}) AS token FROM benchmark), t AS (SELECT DISTINCT unnest({S.tokens()}) AS token FROM documents)
SELECT token FROM t EXCEPT SELECT token FROM h""")
def set_difference(spark, sf):
    tokens = lambda name: texts(spark, sf, name).select(F.explode(T.tokens(F.col("text"))).alias("token"))
    return SE.set_difference(tokens("documents"), tokens("benchmark"), "token")


@query("distinct_triples", "SELECT DISTINCT md5(text) AS digest, lang, source FROM documents")
def distinct_triples(spark, sf):
    return SE.distinct_rows(docs(spark, sf).withColumn("digest", F.md5("text")), ["digest", "lang", "source"])
