"""Sources and sinks: files are written from the driver tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as ST

from loomset.functions import text as T
from loomset.session import scratch_path
from loomset.sources import readers, schemas, writers

from . import sqltext as S
from .registry import query, table
from .views import samples, split_of


def _packed(df, sample_id, style):
    text = F.col("text")
    return df.select(
        sample_id.alias("sample_id"), F.lit("1").alias("generator_version"),
        F.struct(text.alias("text"), T.est_tokens_words(text).cast("int").alias("token_count"), F.lit(style).alias("style")).alias("raw_input"),
        F.struct(F.lit("document").alias("document_type"), F.when(F.col("n_chars") > 800, "complex").otherwise("simple").alias("complexity_level"),
                 F.col("lang").alias("industry")).alias("classification"),
    )


# a second batch re-issues the long documents, a third one lacks ids
@query("scan_samples", f"""
SELECT CAST(doc_id AS VARCHAR) AS sample_id, CASE WHEN n_chars > 2000 THEN 'revised' ELSE 'first' END AS style,
       CASE WHEN n_chars > 800 THEN 'complex' ELSE 'simple' END AS complexity, lang AS industry,
       CASE WHEN n_chars > 2000 THEN 'batch_2' ELSE 'batch_1' END AS folder,
       {S.est_tokens()} AS tokens
FROM documents""")
def scan_samples(spark, sf):
    docs, root = table(spark, sf, "documents"), scratch_path(spark, "samples")
    _packed(docs, F.col("doc_id").cast("string"), "first").write.json(f"{root}/batch_1")
    _packed(docs.where("n_chars > 2000"), F.col("doc_id").cast("string"), "revised").write.json(f"{root}/batch_2")
    _packed(docs.where("lang = 'es'"), F.lit(None).cast("string"), "nameless").write.json(f"{root}/batch_3")
    rows = readers.scan_samples(spark, f"{root}/batch_*")
    return rows.select(
        "sample_id", F.col("raw_input.style").alias("style"),
        readers.complexity_of(F.col("classification")).alias("complexity"),
        F.col("classification.industry").alias("industry"),
        F.regexp_extract("file_path", r"(batch_\d+)", 1).alias("folder"),
        F.col("raw_input.token_count").cast("long").alias("tokens"),
    )


@query("scan_chunks", f"""
SELECT {S.split_of('conv_id')} AS split, CAST(conv_id AS VARCHAR) AS document_id,
       CAST(conv_id AS VARCHAR) || '_c' || CAST(turn AS VARCHAR) AS chunk_id, role AS label, text
FROM conversations""")
def scan_chunks(spark, sf):
    path = scratch_path(spark, "chunks")
    turns = table(spark, sf, "conversations")
    chunks = turns.select(
        split_of(F.col("conv_id")).alias("split"),
        F.when(F.col("turn") % 2 == 0, F.col("conv_id").cast("string")).alias("sample_id"),
        F.concat_ws("_c", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"),
        "text", T.est_tokens_chars(F.col("text")).cast("int").alias("token_count"), F.array("role").alias("labels"),
    )
    writers.write_splits(chunks, path)
    return readers.scan_chunks(spark, path).select(
        "split", "document_id", "chunk_id", F.col("labels")[0].alias("label"), "text"
    )


@query("scan_jsonl_lenient", """
SELECT lang, CAST(count(*) FILTER (lang <> 'de') AS BIGINT) AS good, CAST(count(*) FILTER (lang = 'de') AS BIGINT) AS malformed,
       CAST(coalesce(sum(n_chars) FILTER (lang <> 'de'), 0) AS BIGINT) AS chars
FROM documents GROUP BY lang""")
def scan_jsonl_lenient(spark, sf):
    path = scratch_path(spark, "lines")
    docs = table(spark, sf, "documents")
    line = F.to_json(F.struct("doc_id", "lang", "text", "n_chars"))
    broken = F.concat(F.lit('{"lang": "de", "doc_id": '), F.col("doc_id").cast("string"), F.lit(", broken"))
    lines = docs.select(F.explode(F.array(F.when(F.col("lang") == "de", broken).otherwise(line), F.lit(""))).alias("value"))
    lines.write.text(path)
    schema = ST.StructType.fromDDL("doc_id long, lang string, text string, n_chars long")
    rows = readers.scan_jsonl_lenient(spark, path, schema)
    named = F.coalesce("lang", F.regexp_extract(readers.CORRUPT, r'"lang": "(\w+)"', 1))
    good = ~F.col("malformed")
    return rows.groupBy(named.alias("lang")).agg(
        F.count_if(good).alias("good"), F.count_if(F.col("malformed")).alias("malformed"),
        F.sum(F.when(good, F.col("n_chars")).otherwise(0)).alias("chars"),
    )


@query("scan_text_files", """
SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS chars FROM documents GROUP BY lang""")
def scan_text_files(spark, sf):
    path = scratch_path(spark, "texts")
    table(spark, sf, "documents").select("text", "lang").write.partitionBy("lang").option("maxRecordsPerFile", 10000).text(path)
    files = readers.scan_text_files(spark, path, ("txt",))
    return files.groupBy(F.regexp_extract("source_path", r"lang=(\w+)", 1).alias("lang")).agg(
        F.sum(F.length("text_content")).cast("long").alias("chars")
    )


@query("doc_id_hash", """
SELECT page_id, substr(sha256(url || ':' || CAST(page_id AS VARCHAR)), 1, 16) AS doc_id, sha256(html) AS file_digest FROM pages""")
def doc_id_hash(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select(
        "page_id", readers.doc_id_hash(F.col("url"), F.col("page_id")).alias("doc_id"),
        F.sha2("html", 256).alias("file_digest"),
    )


@query("sink_partitioned_splits", f"""
SELECT {S.split_of()} AS split, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1, 2""")
def sink_partitioned_splits(spark, sf):
    path = scratch_path(spark, "splits")
    docs = table(spark, sf, "documents")
    writers.write_splits(docs.withColumn("split", split_of(F.col("doc_id"))), path)
    back = spark.read.schema("doc_id long, lang string, n_chars long, split string").json(path)
    return back.groupBy("split", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("sink_document_samples", f"""
SELECT source AS source_path, CAST(doc_id AS VARCHAR) AS doc_id, 'full' AS section, text,
       CAST(length(text) AS INTEGER) AS char_len, CAST({S.est_tokens()} AS INTEGER) AS tok_len, {S.est_tokens()} > 480 AS needs_chunking
FROM documents""")
def sink_document_samples(spark, sf):
    path, text = scratch_path(spark, "document-samples"), F.col("text")
    tok = T.est_tokens_words(text)
    rows = writers.document_samples(
        table(spark, sf, "documents"), F.col("source"), F.col("doc_id"), F.lit("full"), text, F.array(text), tok, tok > 480
    )
    rows.write.json(path)
    back = spark.read.schema(schemas.DOCUMENT_SAMPLE).json(path)
    return back.drop("chunks", "template_hint")


@query("sink_batches", """
SELECT CAST(floor((rn - 1) / 100) + 1 AS BIGINT) AS batch_id, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1""")
def sink_batches(spark, sf):
    path = scratch_path(spark, "batches")
    writers.write_batches(writers.number_batches(table(spark, sf, "documents"), "doc_id", 100), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


@query("sink_reports", f"""
WITH {S.SAMPLES}
SELECT 'split' AS section, {S.split_of()} AS key, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM samples GROUP BY 2
UNION ALL SELECT 'split', {S.split_of()}, 'chars', CAST(sum(n_chars) AS DOUBLE) FROM samples GROUP BY 2
UNION ALL SELECT 'duplicate_group', md5(text), 'size', CAST(count(*) AS DOUBLE) FROM samples GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'group_mapping', source, 'rows', CAST(count(*) AS DOUBLE) FROM samples GROUP BY 2
UNION ALL SELECT 'summary', 'all', 'rows', CAST(count(*) AS DOUBLE) FROM samples
UNION ALL SELECT 'summary', 'all', 'ood', CAST(sum(CASE WHEN is_ood THEN 1 ELSE 0 END) AS DOUBLE) FROM samples""")
def sink_reports(spark, sf):
    rows, path = samples(spark, sf), scratch_path(spark, "reports")
    by_split = rows.groupBy(split_of(F.col("doc_id")).alias("split")).agg(
        F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))
    copies = rows.groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("size")).where("size > 1")
    groups = rows.groupBy("source").agg(F.count("*").alias("rows"))
    whole = rows.agg(F.lit("all").alias("scope"), F.count("*").alias("rows"), F.sum(F.col("is_ood").cast("int")).alias("ood"))
    report = (
        writers.long_report(by_split, "split", "split", ["rows", "chars"])
        .unionByName(writers.long_report(copies, "duplicate_group", "digest", ["size"]))
        .unionByName(writers.long_report(groups, "group_mapping", "source", ["rows"]))
        .unionByName(writers.long_report(whole, "summary", "scope", ["rows", "ood"]))
    )
    report.write.parquet(path)
    return spark.read.schema(report.schema).parquet(path)


@query("export_training", f"""
WITH {S.SAMPLES}
SELECT lang, count(*) AS n, round(avg(coherence), 6) AS mean_coherence, (SELECT count(*) FROM samples) AS total
FROM samples GROUP BY lang""")
def export_training(spark, sf):
    rows, root = samples(spark, sf), scratch_path(spark, "training")
    rows.write.parquet(f"{root}/data")
    data = spark.read.schema(rows.schema).parquet(f"{root}/data")
    stats = data.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg("coherence"), 6).alias("mean_coherence"))
    stats.write.parquet(f"{root}/stats")
    total = data.agg(F.count("*")).scalar()
    return spark.read.schema(stats.schema).parquet(f"{root}/stats").withColumn("total", total)


# the target lacks the Spanish documents, holds squeezed texts and has the benchmark on top
@query("manifest_diff", f"""
WITH src AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS path, sha256(text) AS digest FROM documents),
tgt AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS path, sha256({S.squeeze()}) AS digest FROM documents WHERE lang <> 'es'
        UNION ALL SELECT 'b' || CAST(item_id AS VARCHAR), sha256(text) FROM benchmark)
SELECT coalesce(s.path, t.path) AS path, CASE WHEN t.path IS NULL THEN 'new' WHEN s.path IS NULL THEN 'removed'
       WHEN s.digest <> t.digest THEN 'updated' ELSE 'unchanged' END AS status
FROM src s FULL OUTER JOIN tgt t ON s.path = t.path""")
def manifest_diff(spark, sf):
    docs = table(spark, sf, "documents")
    path = F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path")
    ours = docs.select(path, F.sha2("text", 256).alias("digest"))
    theirs = docs.where("lang <> 'es'").select(path, F.sha2(T.normalize_whitespace(F.col("text")), 256).alias("digest"))
    extra = table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("path"), F.sha2("text", 256).alias("digest"))
    return writers.manifest_diff(ours, theirs.unionByName(extra))


@query("snapshot_retention", """
WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age_rank FROM events)
SELECT user_id, event_id AS version, age_rank, (SELECT count(*) FROM r x WHERE x.user_id = r.user_id AND x.age_rank > 3) AS expired
FROM r WHERE age_rank <= 3""")
def snapshot_retention(spark, sf):
    saves = table(spark, sf, "events").select("user_id", F.col("event_id").alias("version"), "ts")
    kept = writers.retained_versions(saves, "user_id", "version", "ts", 3)
    gone = writers.expired_versions(saves, "user_id", "version", "ts", 3).groupBy("user_id").agg(F.count("*").alias("expired"))
    return kept.join(gone, "user_id", "left").select(
        "user_id", "version", "age_rank", F.coalesce("expired", F.lit(0)).cast("long").alias("expired"))
