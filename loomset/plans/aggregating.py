"""Aggregations over documents, labels, orders and events."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from loomset.functions import rules as R
from loomset.functions import text as T
from loomset.operators import dedup as D
from loomset.operators import graphs as G
from loomset.operators import stats as ST
from loomset.operators import vectors as V
from loomset.operators.neardup import near_dup_text_pairs
from loomset.operators.ranking import top_k_counts, top_n_per_group
from loomset.operators.split import SPLITS
from loomset.operators.stats import long_rows

from . import sqltext as S
from .joining import NEAR, SQL_VEC_PAIRS, sql_text_pairs, vecs
from .registry import query, quoted, small_table, table, texts
from .views import doc_labels, samples, split_of, with_scores


def docs(spark, sf):
    return table(spark, sf, "documents")


def r6(name):
    return F.round(F.col(name), 6).alias(name)


@query("exact_dup_groups", """
SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE trim(text) <> '' GROUP BY text HAVING count(*) > 1""")
def exact_dup_groups(spark, sf):
    return D.exact_dup_groups(docs(spark, sf), "doc_id", "text")


def sql_components(edges: str) -> str:
    return f"""
both_ways AS (SELECT a AS u, b AS v FROM {edges} UNION SELECT b, a FROM {edges}),
reach AS (SELECT u, v FROM both_ways UNION SELECT r.u, e.v FROM reach r JOIN both_ways e ON r.v = e.u),
comps AS (SELECT u AS id, least(u, min(v)) AS component FROM reach GROUP BY u)"""


@query("dup_components", f"WITH RECURSIVE {SQL_VEC_PAIRS}, {sql_components('pairs')} SELECT id, component FROM comps")
def dup_components(spark, sf):
    return G.components(V.near_dup_pairs(vecs(spark, sf), "id", "vec", NEAR))


SQL_RESOLVED = f"""{sql_text_pairs(0.7)}, {S.SAMPLES}, {sql_components('text_pairs')},
exact AS (
  SELECT doc_id, kept FROM (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text ORDER BY coherence DESC, is_ood, CAST(doc_id AS VARCHAR) DESC) AS kept FROM samples) WHERE doc_id <> kept),
rest AS (SELECT c.component, s.* FROM comps c JOIN samples s ON s.doc_id = c.id WHERE c.id NOT IN (SELECT doc_id FROM exact)),
close AS (
  SELECT doc_id, kept FROM (SELECT doc_id, first_value(doc_id) OVER (PARTITION BY component ORDER BY coherence DESC, is_ood, CAST(doc_id AS VARCHAR) DESC) AS kept FROM rest) WHERE doc_id <> kept),
resolved AS (
  SELECT doc_id AS id, 'exact_duplicate_of_' || CAST(kept AS VARCHAR) AS reason FROM exact
  UNION ALL SELECT doc_id, 'near_duplicate_of_' || CAST(kept AS VARCHAR) FROM close)"""


@query("resolve_duplicates", f"WITH RECURSIVE {SQL_RESOLVED} SELECT id, reason FROM resolved")
def resolve_duplicates(spark, sf):
    near = near_dup_text_pairs(texts(spark, sf), "doc_id", "text", 0.7)
    return D.resolve_duplicates(texts(spark, sf), near, "doc_id", scored=partial(with_scores, spark, sf))


@query("dedup_stats", f"""
WITH pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {NEAR}),
g AS (SELECT text, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY text HAVING count(*) > 1)
SELECT (SELECT count(*) FROM g) AS exact_groups, (SELECT CAST(sum(n - 1) AS BIGINT) FROM g) AS exact_excess,
       (SELECT count(*) FROM pairs) AS near_pairs, (SELECT count(*) FROM (SELECT a FROM pairs UNION SELECT b FROM pairs)) AS near_affected""")
def dedup_stats(spark, sf):
    groups = D.exact_dup_groups(docs(spark, sf), "doc_id", "text").agg(
        F.count("*").alias("exact_groups"), F.sum(F.col("n") - 1).alias("exact_excess"))
    # pairs of copies are counted from the sizes of their groups, not formed
    sizes = vecs(spark, sf).groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    pairs = V.all_pairs(sizes.select("id", "vec"), NEAR)
    ends = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
    others = pairs.select(F.inline(ends)).join(sizes.select(F.col("id").alias("other"), F.col("n").alias("m")), "other")
    linked = sizes.join(others.groupBy("id").agg(F.sum("m").alias("m")), "id", "left")
    each = (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("each")
    near = linked.select("n", each).where("each > 0").agg(
        F.coalesce(F.sum(F.col("n") * F.col("each")) / 2, F.lit(0)).cast("long").alias("near_pairs"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("near_affected"))
    return groups.join(near)


@query("class_distribution", f"""
WITH {S.SAMPLES}, f AS (
  SELECT {S.split_of()} AS split, unnest([struct_pack(facet := 'lang', value := lang), struct_pack(facet := 'source', value := source), struct_pack(facet := 'is_ood', value := CAST(is_ood AS VARCHAR))]) AS p FROM samples)
SELECT split, p.facet AS facet, p.value AS value, count(*) AS n FROM f GROUP BY ALL""")
def class_distribution(spark, sf):
    rows = samples(spark, sf).withColumn("split", split_of(F.col("doc_id")))
    return ST.facet_counts(rows, ["lang", "source", "is_ood"], ["split"])


@query("pivot_label_split", f"""
WITH {S.DOC_LABELS}, l AS (SELECT split, unnest(labels) AS label FROM doc_labels)
SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM l GROUP BY label""")
def pivot_label_split(spark, sf):
    long = doc_labels(spark, sf).select("split", F.explode("labels").alias("label"))
    return ST.pivot_counts(long, "label", "split", SPLITS)


SQL_COMBO = "array_to_string(list_sort(labels), '|')"


@query("label_combos", f"""
WITH {S.DOC_LABELS}, c AS (SELECT {SQL_COMBO} AS combo, split FROM doc_labels)
SELECT combo, count(*) AS n, round(count(*) FILTER (split = 'train') / count(*), 6) AS train_share,
       round(count(*) FILTER (split = 'val') / count(*), 6) AS val_share, round(count(*) FILTER (split = 'test') / count(*), 6) AS test_share
FROM c GROUP BY combo ORDER BY n DESC, combo LIMIT 20""")
def label_combos(spark, sf):
    rows = doc_labels(spark, sf).select(ST.combo(F.col("labels")).alias("combo"), "split")
    share = lambda s: F.round(F.count_if(F.col("split") == s) / F.count("*"), 6).alias(f"{s}_share")
    counted = rows.groupBy("combo").agg(F.count("*").alias("n"), *[share(s) for s in SPLITS])
    return counted.orderBy(F.col("n").desc(), "combo").limit(20)


def _sql_length(column, std, by, source):
    return f"""SELECT {by} AS split, count(*) AS n, round(avg({column}), 6) AS mean, round({std}({column}), 4) AS std,
       min({column}) AS min, max({column}) AS max, quantile_cont({column}, 0.25) AS q25, quantile_cont({column}, 0.5) AS median, quantile_cont({column}, 0.75) AS q75
FROM {source} GROUP BY 1"""


def _length_rows(rows, column, sample_std):
    both = ST.length_stats(rows, column, ["split"], sample_std).unionByName(
        ST.length_stats(rows, column, [], sample_std).withColumn("split", F.lit("all")))
    return both.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 4))


@query("length_stats_pop", f"""
WITH x AS (SELECT n_chars, {S.split_of()} AS split FROM documents)
{_sql_length('n_chars', 'stddev_pop', 'split', 'x')} UNION ALL {_sql_length('n_chars', 'stddev_pop', "'all'", 'x')}""")
def length_stats_pop(spark, sf):
    return _length_rows(docs(spark, sf).select("n_chars", split_of(F.col("doc_id")).alias("split")), "n_chars", False)


@query("length_stats_samp", f"""
WITH x AS (SELECT {S.est_tokens()} AS tokens, {S.split_of()} AS split FROM documents)
{_sql_length('tokens', 'stddev_samp', 'split', 'x')} UNION ALL {_sql_length('tokens', 'stddev_samp', "'all'", 'x')}""")
def length_stats_samp(spark, sf):
    rows = texts(spark, sf).select(T.est_tokens_words(F.col("text")).alias("tokens"), split_of(F.col("doc_id")).alias("split"))
    return _length_rows(rows, "tokens", True)


@query("length_histogram", """
WITH b AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents),
c AS (SELECT CAST(least(floor((n_chars - lo) / ((hi - lo) / 50.0::DOUBLE)), 49) AS BIGINT) AS bin, count(*) AS n, min(n_chars) AS lowest, max(n_chars) AS highest
  FROM documents, b GROUP BY 1)
SELECT bin, coalesce(n, 0) AS n, lowest, highest FROM (SELECT unnest(range(50)) AS bin) LEFT JOIN c USING (bin)""")
def length_histogram(spark, sf):
    return ST.histogram(docs(spark, sf), "n_chars", 50)


@query("length_by_combo", f"""
WITH {S.DOC_LABELS}, c AS (SELECT {SQL_COMBO} AS combo, n_chars FROM doc_labels JOIN documents USING (doc_id)),
top AS (SELECT combo FROM c GROUP BY combo ORDER BY count(*) DESC, combo LIMIT 15)
SELECT combo, count(*) AS n, min(n_chars)::DOUBLE AS p0, quantile_cont(n_chars, 0.25) AS q25, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q75, max(n_chars)::DOUBLE AS p100
FROM c WHERE combo IN (SELECT combo FROM top) GROUP BY combo""")
def length_by_combo(spark, sf):
    labelled = doc_labels(spark, sf).select("doc_id", ST.combo(F.col("labels")).alias("combo"))
    rows = labelled.join(docs(spark, sf).select("doc_id", "n_chars"), "doc_id")
    top = top_k_counts(labelled, "combo", 15).select("combo")
    kept = rows.join(top, "combo", "left_semi")
    points = {"p0": 0.0, **ST.QUARTILES, "p100": 1.0}
    return ST.exact_percentiles(kept, "n_chars", points, ["combo"]).join(
        kept.groupBy("combo").agg(F.count("*").alias("n")), "combo")


_FIELDS = {
    "client": ("source", "source"),
    "brand": ("CASE WHEN lang <> 'en' THEN lang ELSE 'unknown' END", "if(lang <> 'en', lang, 'unknown')"),
    "campaign": ("CASE WHEN quality = 1 THEN 'good' ELSE 'N/A' END", "if(quality = 1, 'good', 'N/A')"),
    "fee": ("CASE WHEN contains(text, '$') THEN '$' ELSE '' END", "if(contains(text, '$'), '$', '')"),
    "territory": ("CASE WHEN n_chars > 2000 THEN 'wide' END", "if(n_chars > 2000, 'wide', null)"),
}
_TRUTHY = "coalesce({0}, '') NOT IN ('', 'N/A', 'unknown')"
SQL_FIELDS = "fields AS (SELECT doc_id, list_filter([" + ", ".join(
    f"CASE WHEN {_TRUTHY.format('(' + sql + ')')} THEN '{name}' END" for name, (sql, _) in _FIELDS.items()
) + "], lambda x: x IS NOT NULL) AS present FROM documents LEFT JOIN labels USING (doc_id))"


def field_map(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    pairs = [F.struct(F.lit(n).alias("key"), F.expr(e).alias("value")) for n, (_, e) in _FIELDS.items()]
    return rows.select("doc_id", F.map_from_entries(F.array(*pairs)).alias("fields"))


def present(fields):
    """Names of the fields with a value that says something."""
    told = F.map_filter(fields, lambda k, v: ~F.coalesce(v, F.lit("")).isin("", "N/A", "unknown"))
    return F.map_keys(told)


@query("field_frequency", f"""
WITH {SQL_FIELDS}, n AS (SELECT count(*) AS total FROM documents)
SELECT f AS field, count(*) AS n, round(count(*) / max(total), 6) AS share FROM (SELECT unnest(present) AS f FROM fields), n GROUP BY f""")
def field_frequency(spark, sf):
    rows = field_map(spark, sf)
    total = rows.agg(F.count("*")).scalar()
    counted = rows.select(F.explode(present(F.col("fields"))).alias("field")).groupBy("field").agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / total, 6))


@query("field_cooccurrence", f"""
WITH {SQL_FIELDS}, e AS (SELECT doc_id, unnest(present) AS f FROM fields)
SELECT x.f AS first, y.f AS second, count(*) AS n, round(ln(count(*) + 1), 6) AS log_n FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.f < y.f
GROUP BY 1, 2 ORDER BY n DESC, first, second LIMIT 20""")
def field_cooccurrence(spark, sf):
    rows = field_map(spark, sf).select("doc_id", present(F.col("fields")).alias("present"))
    counted = ST.pair_counts(rows, "doc_id", "present").withColumn("log_n", F.round(F.log1p("n"), 6))
    return counted.orderBy(F.col("n").desc(), "first", "second").limit(20)


@query("label_cooccurrence", f"""
WITH {S.DOC_LABELS}, e AS (SELECT doc_id, unnest(labels) AS f FROM doc_labels)
SELECT x.f AS first, y.f AS second, count(*) AS n, round(ln(count(*) + 1), 6) AS log_n FROM e x JOIN e y ON x.doc_id = y.doc_id GROUP BY 1, 2""")
def label_cooccurrence(spark, sf):
    return ST.pair_counts(doc_labels(spark, sf), "doc_id", "labels", ordered=True).withColumn("log_n", F.round(F.log1p("n"), 6))


@query("combo_overlap", f"""
WITH {S.DOC_LABELS}, c AS (SELECT DISTINCT {SQL_COMBO} AS combo, split FROM doc_labels), p(a, b) AS (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')),
o AS (SELECT a, b, (SELECT count(*) FROM c x JOIN c y ON x.combo = y.combo WHERE x.split = a AND y.split = b) AS shared,
      (SELECT count(DISTINCT combo) FROM c WHERE split IN (a, b)) AS total FROM p)
SELECT a, b, shared, total, round(shared / total, 6) AS jaccard FROM o""")
def combo_overlap(spark, sf):
    rows = doc_labels(spark, sf).select(ST.combo(F.col("labels")).alias("combo"), "split")
    return ST.jaccard_of_sets(rows, "combo", "split", SPLITS).withColumn("jaccard", F.round("jaccard", 6))


@query("split_stats", f"""
WITH {S.DOC_LABELS}, l AS (SELECT unnest(labels) AS label, split FROM doc_labels), t AS (SELECT split, count(*) AS docs FROM doc_labels GROUP BY split)
SELECT split, label, count(*) AS n, max(docs) AS docs, round(100.0 * count(*) / max(docs), 1)::DOUBLE AS percent
FROM l JOIN t USING (split) GROUP BY split, label""")
def split_stats(spark, sf):
    rows = doc_labels(spark, sf)
    sizes = rows.groupBy("split").agg(F.count("*").alias("docs"))
    counted = rows.select("split", F.explode("labels").alias("label")).groupBy("split", "label").agg(F.count("*").alias("n"))
    return counted.join(sizes, "split").withColumn("percent", F.round(100.0 * F.col("n") / F.col("docs"), 1))


# temporal_ok: the years that a text names do not run backwards
@query("quality_metrics", f"""
WITH {S.SAMPLES}, y AS (SELECT *, regexp_extract_all(text, '(?:19|20)[0-9][0-9]') AS years FROM samples)
SELECT lang, round(avg(coherence), 6) AS mean, quantile_cont(coherence, 0.5) AS median, round(stddev_pop(coherence), 6) AS std, min(coherence) AS min, max(coherence) AS max,
       round(100.0 * avg(CASE WHEN is_ood THEN 0 ELSE 1 END), 4)::DOUBLE AS business_ok_percent,
       round(100.0 * avg(CASE WHEN years = list_sort(years) THEN 1 ELSE 0 END), 4)::DOUBLE AS temporal_ok_percent
FROM y GROUP BY lang""")
def quality_metrics(spark, sf):
    years = F.regexp_extract_all("text", F.lit("(?:19|20)[0-9][0-9]"), 0)
    return ST.quality_metrics(
        samples(spark, sf), "lang", "coherence", {"business_ok": ~F.col("is_ood"), "temporal_ok": years == F.array_sort(years)})


# batches of 100 documents; the fee of a document is that of the order of its number, if there is one
@query("batch_metadata", f"""
WITH {S.SAMPLES},
o AS (
  SELECT doc_id // 100 AS batch_id, source AS document_type, lang AS industry, CASE WHEN n_chars > 4000 THEN 'long' WHEN n_chars > 800 THEN 'mid' ELSE 'short' END AS complexity,
         is_ood, coherence, {S.est_tokens()} AS tokens, CASE WHEN coalesce(floor(o_totalprice / 10), 0) > 0 THEN CAST(floor(o_totalprice / 10) AS BIGINT) END AS fee
  FROM samples LEFT JOIN orders ON o_orderkey = doc_id),
b AS (
  SELECT batch_id, count(*) AS n, count(*) FILTER (is_ood) AS ood, count(*) FILTER (coherence >= 0.1) AS coherent, round(avg(tokens), 6) AS token_mean,
         min(tokens) AS token_min, max(tokens) AS token_max, round(stddev_pop(tokens), 4) AS token_std, min(fee) AS min_fee, max(fee) AS max_fee
  FROM o GROUP BY batch_id),
k AS (
  SELECT batch_id, 'document_type' AS section, document_type AS key FROM o UNION ALL SELECT batch_id, 'industry', industry FROM o
  UNION ALL SELECT batch_id, 'complexity', complexity FROM o
  UNION ALL SELECT batch_id, 'fee_bracket', CASE WHEN fee >= 1000 THEN CAST(fee // 1000 AS VARCHAR) || 'k' ELSE '<1k' END FROM o WHERE fee > 0)
SELECT b.*, section, key, in_key FROM b JOIN (SELECT batch_id, section, key, count(*) AS in_key FROM k GROUP BY ALL) USING (batch_id)""")
def batch_metadata(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.floor(F.col("o_totalprice") / 10).cast("long").alias("fee"))
    size = F.when(F.col("n_chars") > 4000, "long").when(F.col("n_chars") > 800, "mid").otherwise("short")
    rows = samples(spark, sf).select(
        "doc_id", F.floor(F.col("doc_id") / 100).alias("batch_id"), F.col("source").alias("document_type"), F.col("lang").alias("industry"),
        size.alias("complexity"), "is_ood", "coherence", T.est_tokens_words(F.col("text")).alias("tokens"),
    ).join(orders, "doc_id", "left")
    return ST.batch_metadata(
        rows, "batch_id", ["document_type", "industry", "complexity"], "fee", "tokens", F.col("is_ood"), F.col("coherence") >= 0.1)


@query("quality_report", f"""
WITH {S.SAMPLES}, t AS (SELECT count(*) AS n FROM samples), top AS (SELECT source, count(*) AS c FROM samples GROUP BY source ORDER BY c DESC, source LIMIT 5)
SELECT 'share' AS metric, 'ood' AS key, round(avg(CASE WHEN is_ood THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS value FROM samples
UNION ALL SELECT 'share', 'coherent', round(avg(CASE WHEN coherence >= 0.1 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE FROM samples
UNION ALL SELECT 'industry', source, round(100.0 * c / n, 6)::DOUBLE FROM top, t
UNION ALL SELECT 'fee', unnest(['mean', 'median', 'min', 'max']), unnest([round(avg(o_totalprice), 4), round(quantile_cont(o_totalprice, 0.5), 4), min(o_totalprice), max(o_totalprice)]) FROM orders WHERE o_totalprice > 0""")
def quality_report(spark, sf):
    rows, fees = samples(spark, sf), table(spark, sf, "orders").where("o_totalprice > 0")
    shares = rows.agg(F.round(F.avg(F.col("is_ood").cast("int")), 6).alias("ood"),
                      F.round(F.avg((F.col("coherence") >= 0.1).cast("int")), 6).alias("coherent"))
    total = rows.agg(F.count("*")).scalar()
    top = top_k_counts(rows, "source", 5).select(
        F.lit("industry").alias("metric"), F.col("source").alias("key"), F.round(100.0 * F.col("n") / total, 6).alias("value"))
    fee = fees.agg(F.round(F.avg("o_totalprice"), 4).alias("mean"), F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"))
    middle = ST.exact_percentiles(fees, "o_totalprice", {"median": 0.5}).select(F.round("median", 4).alias("median"))
    return long_rows(shares, "share").unionByName(top).unionByName(long_rows(fee, "fee")).unionByName(long_rows(middle, "fee"))


@query("score_metric_summary", """
SELECT event_type AS metric, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events GROUP BY event_type
UNION ALL SELECT 'k', count(*), round(avg(k), 6), min(k), max(k) FROM (SELECT CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)""")
def score_metric_summary(spark, sf):
    scores = F.map_from_arrays(
        F.array(F.col("event_type"), F.lit("k")),
        F.array(F.col("value"), F.get_json_object("props", "$.k").cast("double")))
    long = table(spark, sf, "events").select(F.explode(scores).alias("metric", "v"))
    return long.groupBy("metric").agg(F.count("v").alias("n"), F.round(F.avg("v"), 6).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"))


@query("quality_buckets", """
WITH q AS (SELECT CASE WHEN value / 100 > 0.9 THEN 'excellent' WHEN value / 100 > 0.7 THEN 'good' WHEN value / 100 > 0.5 THEN 'fair' ELSE 'poor' END AS bucket,
           event_type = 'error' AS broken FROM events), t AS (SELECT count(*) AS n FROM events)
SELECT bucket, count(*) AS n, count(*) FILTER (broken) AS business_logic, bucket = 'poor' AND count(*) > 0.1 * max(t.n) AS advise_review FROM q, t GROUP BY bucket""")
def quality_buckets(spark, sf):
    score = F.col("value") / 100
    bucket = R.first_match([(score > 0.9, "excellent"), (score > 0.7, "good"), (score > 0.5, "fair")], "poor")
    rows = table(spark, sf, "events")
    counted = rows.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("business_logic"))
    total = rows.agg(F.count("*")).scalar()
    return counted.withColumn("advise_review", (F.col("bucket") == "poor") & (F.col("n") > 0.1 * total))


# share of every class the dataset should have
TARGETS = [
    ("fee", "low", 0.4), ("fee", "mid", 0.4), ("fee", "premium", 0.2),
    ("complexity", "simple", 0.5), ("complexity", "medium", 0.3), ("complexity", "complex", 0.2),
    ("lang", "en", 0.7), ("lang", "fr", 0.15), ("lang", "it", 0.15),
]
SQL_BALANCE = f"""
targets(facet, value, target) AS (VALUES {', '.join(f"('{a}', '{b}', {c}::DOUBLE)" for a, b, c in TARGETS)}),
obs AS (
  SELECT 'fee' AS facet, CASE WHEN o_totalprice / 10 <= 8000 THEN 'low' WHEN o_totalprice / 10 <= 18000 THEN 'mid' ELSE 'premium' END AS value FROM orders WHERE o_totalprice > 0
  UNION ALL SELECT 'complexity', CASE WHEN n_chars > 4000 THEN 'complex' WHEN n_chars > 800 THEN 'medium' ELSE 'simple' END FROM documents
  UNION ALL SELECT 'lang', lang FROM documents),
tot AS (SELECT facet, count(*) AS total FROM obs GROUP BY facet), cnt AS (SELECT facet, value, count(*) AS c FROM obs GROUP BY ALL),
balance AS (SELECT facet, avg(1 - abs(coalesce(c, 0) / total - target)) AS balance FROM targets LEFT JOIN tot USING (facet) LEFT JOIN cnt USING (facet, value) GROUP BY facet),
overall AS (SELECT avg(balance) AS balance FROM balance)"""


def balance(spark, sf):
    fee = F.col("o_totalprice") / 10
    size = R.first_match([(F.col("n_chars") > 4000, "complex"), (F.col("n_chars") > 800, "medium")], "simple")
    fees = table(spark, sf, "orders").where("o_totalprice > 0").select(
        F.lit("fee").alias("facet"), R.first_match([(fee <= 8000, "low"), (fee <= 18000, "mid")], "premium").alias("value"))
    named = docs(spark, sf).select(F.map_from_arrays(
        F.array(F.lit("complexity"), F.lit("lang")), F.array(size, F.col("lang"))).alias("m"))
    facets = named.select(F.explode("m").alias("facet", "value"))
    targets = small_table(spark, ("facet", "value", "target"), TARGETS)
    return ST.balance_scores(fees.unionByName(facets), targets)


@query("distribution_balance", f"WITH {SQL_BALANCE} SELECT facet, round(balance, 6) AS balance FROM balance UNION ALL SELECT 'overall', round(balance, 6) FROM overall")
def distribution_balance(spark, sf):
    scores = balance(spark, sf)
    overall = scores.agg(F.lit("overall").alias("facet"), F.avg("balance").alias("balance"))
    return scores.unionByName(overall).withColumn("balance", F.round("balance", 6))


SQL_EXTRACT = """
extracted AS (SELECT doc_id, array_to_string(list_filter([
    CASE WHEN NOT contains(text, upper(substr(source, 1, 1))) THEN 'influencer' END,
    CASE WHEN n_chars > 2000 AND NOT contains(text, '$') AND NOT contains(lower(text), 'budget') THEN 'fee' END,
    CASE WHEN NOT contains(lower(text), 'the ') AND NOT contains(lower(text), 'der ') THEN 'deliverables' END,
    CASE WHEN NOT contains(text, lang) THEN 'brand' END], lambda x: x IS NOT NULL), '|') AS missing FROM documents)"""


def extracted(spark, sf):
    text = F.col("text")
    low = F.lower(text)
    rules = [
        ("influencer", ~text.contains(F.upper(F.substring("source", 1, 1)))),
        ("fee", (F.col("n_chars") > 2000) & ~text.contains("$") & ~low.contains("budget")),
        ("deliverables", ~F.exists(F.array(F.lit("the "), F.lit("der ")), lambda d: low.contains(d))),
        ("brand", ~text.contains(F.col("lang"))),
    ]
    return docs(spark, sf).select("doc_id", R.joined(R.issues(rules)).alias("missing"))


@query("extractability", f"""
WITH {SQL_EXTRACT}
SELECT missing, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM extracted GROUP BY missing""")
def extractability(spark, sf):
    return ST.with_shares(extracted(spark, sf).groupBy("missing").agg(F.count("*").alias("n"))).withColumn("share", F.round("share", 6))


SQL_ORDER_ITEMS = """
order_items AS (SELECT o.o_orderkey, floor(o.o_totalprice / 10)::BIGINT AS fee, count(l.l_orderkey) AS items,
                count(*) FILTER (l.l_returnflag = 'R') AS returned FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY ALL)"""


def order_items(spark, sf):
    """Orders as agreements: a tenth of the price is the fee, the lines are the deliverables."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("items"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    return table(spark, sf, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 10).cast("long").alias("fee")).join(
        lines, "o_orderkey", "left").fillna(0, ["items", "returned"])


SQL_COHERENCE = f"""{SQL_ORDER_ITEMS},
contradictions AS (SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN fee > 20000 AND items < 3 THEN 'high_fee_few_items' END, CASE WHEN fee < 3000 AND items > 5 THEN 'low_fee_many_items' END,
  CASE WHEN returned > 2 THEN 'term_clash' END], lambda x: x IS NOT NULL), '|') AS issues FROM order_items)"""


def contradictions(spark, sf):
    rules = [
        ("high_fee_few_items", (F.col("fee") > 20000) & (F.col("items") < 3)),
        ("low_fee_many_items", (F.col("fee") < 3000) & (F.col("items") > 5)),
        ("term_clash", F.col("returned") > 2),
    ]
    return order_items(spark, sf).select("o_orderkey", R.joined(R.issues(rules)).alias("issues"))


@query("coherence_rules_rate", f"""
WITH {SQL_COHERENCE} SELECT issues, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM contradictions GROUP BY issues""")
def coherence_rules_rate(spark, sf):
    return ST.with_shares(contradictions(spark, sf).groupBy("issues").agg(F.count("*").alias("n"))).withColumn("share", F.round("share", 6))


@query("token_length_score", """
SELECT round(avg(CASE WHEN length(text) / 4 <= 512 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS score, round(avg(length(text) / 4), 6) AS mean_tokens, max(length(text) / 4) AS max_tokens FROM documents""")
def token_length_score(spark, sf):
    tokens = F.length("text") / 4
    return docs(spark, sf).agg(
        F.round(F.avg((tokens <= 512).cast("double")), 6).alias("score"), F.round(F.avg(tokens), 6).alias("mean_tokens"),
        F.max(tokens).alias("max_tokens"))


@query("validation_verdict", f"""
WITH {SQL_BALANCE}, {SQL_EXTRACT}, {SQL_COHERENCE},
s AS (SELECT (SELECT balance FROM overall) AS balance, (SELECT avg(CASE WHEN missing = '' THEN 1.0 ELSE 0.0 END) FROM extracted)::DOUBLE AS extraction,
      (SELECT avg(CASE WHEN issues = '' THEN 1.0 ELSE 0.0 END) FROM contradictions)::DOUBLE AS coherence, (SELECT avg(CASE WHEN length(text) / 4 <= 512 THEN 1.0 ELSE 0.0 END) FROM documents)::DOUBLE AS length)
SELECT round((extraction + coherence + length) / 3, 6) AS score, balance >= 0.8 AND extraction >= 0.95 AND coherence >= 0.85 AND length >= 0.9 AS passed,
  array_to_string(list_filter([CASE WHEN balance < 0.8 THEN 'balance' END, CASE WHEN extraction < 0.95 THEN 'extraction' END, CASE WHEN coherence < 0.85 THEN 'coherence' END, CASE WHEN length < 0.9 THEN 'length' END], lambda x: x IS NOT NULL), '|') AS issues
FROM s""")
def validation_verdict(spark, sf):
    clear = lambda c: F.avg((F.col(c) == "").cast("double"))
    scores = (
        balance(spark, sf).agg(F.avg("balance").alias("balance"))
        .join(extracted(spark, sf).agg(clear("missing").alias("extraction")))
        .join(contradictions(spark, sf).agg(clear("issues").alias("coherence")))
        .join(docs(spark, sf).agg(F.avg((F.length("text") / 4 <= 512).cast("double")).alias("length")))
    )
    limits = {"balance": 0.8, "extraction": 0.95, "coherence": 0.85, "length": 0.9}
    issues = R.issues([(name, F.col(name) < bound) for name, bound in limits.items()])
    return scores.select(
        F.round((F.col("extraction") + F.col("coherence") + F.col("length")) / 3, 6).alias("score"),
        (F.size(issues) == 0).alias("passed"), R.joined(issues).alias("issues"))


@query("dataset_metadata", """
WITH s AS (SELECT o_totalprice AS fee, row_number() OVER (ORDER BY o_totalprice) - 1 AS i, count(*) OVER () AS n FROM orders WHERE o_totalprice > 0)
SELECT count(*) AS n, min(fee) AS min_fee, max(fee) AS max_fee, round(avg(fee), 4) AS mean_fee, max(fee) FILTER (i = n // 2) AS median_fee FROM s""")
def dataset_metadata(spark, sf):
    fees = table(spark, sf, "orders").where("o_totalprice > 0").select(F.col("o_totalprice").alias("fee"))
    whole = fees.agg(F.count("*").alias("n"), F.min("fee").alias("min_fee"), F.max("fee").alias("max_fee"), F.round(F.avg("fee"), 4).alias("mean_fee"))
    return whole.join(ST.upper_median(fees, "fee", 10000.0).select(F.col("median").alias("median_fee")))


@query("group_size_stats", """
SELECT count(*) AS groups, min(n) AS min_size, max(n) AS max_size, round(avg(n), 6) AS mean_size FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)""")
def group_size_stats(spark, sf):
    sizes = table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("groups"), F.min("n").alias("min_size"), F.max("n").alias("max_size"), F.round(F.avg("n"), 6).alias("mean_size"))


@query("group_majority", """
WITH c AS (SELECT source, lang, count(*) AS c FROM documents GROUP BY ALL)
SELECT source, CAST(sum(c) AS BIGINT) AS size, (SELECT lang FROM c x WHERE x.source = c.source ORDER BY c DESC, lang LIMIT 1) AS lang FROM c GROUP BY source""")
def group_majority(spark, sf):
    return ST.group_majority(docs(spark, sf), "source", "lang")


SQL_PROFILE = """
rc AS (SELECT conv_id, role, count(*) AS c FROM conversations GROUP BY ALL),
profiles AS (SELECT conv_id, array_to_string(list_sort(list(role || ':' || printf('%.2f', round(c / total, 2)))), '|') AS profile
             FROM (SELECT *, sum(c) OVER (PARTITION BY conv_id) AS total FROM rc) GROUP BY conv_id)"""


@query("label_profile", f"WITH {SQL_PROFILE} SELECT profile, count(*) AS documents FROM profiles GROUP BY profile")
def label_profile(spark, sf):
    made = ST.label_profile(table(spark, sf, "conversations"), "conv_id", "role")
    return made.groupBy("profile").agg(F.count("*").alias("documents"))


SQL_ENHANCED = f"""{S.DOC_LABELS},
enhanced AS (SELECT doc_id, split, labels, {SQL_COMBO} AS combo, len(labels) AS label_count,
  CASE WHEN list_contains(labels, 'toxic') THEN 'distractor' WHEN len(labels) >= 4 THEN 'multi_label' ELSE 'original' END AS sample_type,
  CASE WHEN len(labels) <= 2 THEN 'minimal' WHEN len(labels) <= 3 THEN 'moderate' WHEN len(labels) <= 4 THEN 'complex' ELSE 'comprehensive' END AS complexity FROM doc_labels)"""


def enhanced(spark, sf):
    n = F.size("labels")
    return doc_labels(spark, sf).select(
        "doc_id", "split", "labels", ST.combo(F.col("labels")).alias("combo"), n.cast("long").alias("label_count"),
        R.first_match([(F.array_contains("labels", "toxic"), "distractor"), (n >= 4, "multi_label")], "original").alias("sample_type"),
        R.first_match([(n <= 2, "minimal"), (n <= 3, "moderate"), (n <= 4, "complex")], "comprehensive").alias("complexity"))


@query("enhanced_stats", f"""
WITH {SQL_ENHANCED}
SELECT 'sample_type' AS facet, sample_type AS value, count(*) AS n FROM enhanced GROUP BY 2
UNION ALL SELECT 'complexity', complexity, count(*) FROM enhanced GROUP BY 2
UNION ALL SELECT 'label_count', CAST(label_count AS VARCHAR), count(*) FROM enhanced GROUP BY 2
UNION ALL SELECT 'label', l, count(*) FROM (SELECT unnest(labels) AS l FROM enhanced) GROUP BY 2
UNION ALL SELECT 'unique_combinations', 'all', count(DISTINCT combo) FROM enhanced""")
def enhanced_stats(spark, sf):
    rows = enhanced(spark, sf)
    facets = ST.facet_counts(rows, ["sample_type", "complexity", "label_count"])
    labels = ST.facet_counts(rows.select(F.explode("labels").alias("label")), ["label"])
    combos = rows.agg(F.lit("unique_combinations").alias("facet"), F.lit("all").alias("value"), F.countDistinct("combo").alias("n"))
    return facets.unionByName(labels).unionByName(combos)


# label = source; the bound is low enough to report some
@query("split_balance_check", f"""
WITH x AS (SELECT source AS label, {S.split_of()} AS split FROM documents), c AS (
  SELECT label, count(*) AS n, count(*) FILTER (split = 'train') / count(*) AS train, count(*) FILTER (split = 'val') / count(*) AS val, count(*) FILTER (split = 'test') / count(*) AS test FROM x GROUP BY label)
SELECT label, n, round(train, 6) AS train, round(val, 6) AS val, round(test, 6) AS test FROM c WHERE abs(train - 0.7) > 0.05 OR abs(val - 0.15) > 0.05 OR abs(test - 0.15) > 0.05""")
def split_balance_check(spark, sf):
    rows = docs(spark, sf).select(F.col("source").alias("label"), split_of(F.col("doc_id")).alias("split"))
    counted = ST.pivot_counts(rows, "label", "split", SPLITS).withColumn("n", F.col("train") + F.col("val") + F.col("test"))
    off, shares = F.lit(False), []
    for name, target in zip(SPLITS, (0.7, 0.15, 0.15)):
        share = F.col(name) / F.col("n")
        off = off | (F.abs(share - target) > 0.05)
        shares.append(F.round(share, 6).alias(name))
    return counted.where(off).select("label", "n", *shares)


@query("improvement_checks", f"""
WITH {SQL_ENHANCED}, lab AS (SELECT l, count(*) FILTER (split = 'train') / count(*) AS train FROM (SELECT unnest(labels) AS l, split FROM enhanced) GROUP BY l),
m AS (SELECT count(DISTINCT combo)::DOUBLE AS combos, avg(CASE WHEN sample_type = 'multi_label' THEN 1.0 ELSE 0.0 END)::DOUBLE AS multi, avg(CASE WHEN sample_type = 'distractor' THEN 1.0 ELSE 0.0 END)::DOUBLE AS distract,
      count(DISTINCT complexity)::DOUBLE AS levels, (SELECT avg(CASE WHEN train BETWEEN 0.6 AND 0.8 THEN 1.0 ELSE 0.0 END) FROM lab)::DOUBLE AS balanced FROM enhanced)
SELECT unnest(['combinations', 'multi_label', 'distractor', 'balanced_labels', 'levels']) AS "check", unnest([combos, round(multi, 6), round(distract, 6), round(balanced, 6), levels]) AS value,
       unnest([combos >= 50, multi >= 0.2, distract >= 0.1, balanced >= 0.8, levels >= 3]) AS passed FROM m""")
def improvement_checks(spark, sf):
    rows = enhanced(spark, sf)
    share = lambda t: F.avg((F.col("sample_type") == t).cast("double"))
    facts = rows.agg(F.countDistinct("combo").cast("double").alias("combinations"), share("multi_label").alias("multi_label"),
                     share("distractor").alias("distractor"), F.countDistinct("complexity").cast("double").alias("levels"))
    per = ST.pivot_counts(rows.select("split", F.explode("labels").alias("label")), "label", "split", SPLITS)
    train = F.col("train") / (F.col("train") + F.col("val") + F.col("test"))
    facts = facts.join(per.agg(F.avg(train.between(0.6, 0.8).cast("double")).alias("balanced_labels")))
    bounds = {"combinations": 50, "multi_label": 0.2, "distractor": 0.1, "balanced_labels": 0.8, "levels": 3}
    checks = F.array(*[
        F.struct(F.lit(n).alias("check"), F.round(F.col(n), 6).alias("value"), (F.col(n) >= b).alias("passed")) for n, b in bounds.items()])
    return facts.select(F.inline(checks))


_FLAGS = [
    ("source_share", "below", 0.1, "low representation"), ("source_share", "above", 0.9, "dominant class"),
    ("complexity_share", "below", 0.05, "rare complexity"), ("max_chars", "above", 5000.0, "very long texts"),
    ("max_tokens", "above", 1000.0, "very long texts"), ("mean_tokens", "above", 400.0, "high token mean"),
    ("ood_share", "above", 0.3, "high contamination"), ("ood_share", "below", 0.1, "low contamination"),
]


@query("red_flags", f"""
WITH {S.SAMPLES}, t AS (SELECT *, CASE WHEN n_chars > 4000 THEN 'complex' WHEN n_chars > 800 THEN 'medium' ELSE 'simple' END AS complexity, {S.est_tokens()} AS tokens FROM samples), n AS (SELECT count(*) AS n FROM t),
m AS (SELECT 'source_share' AS metric, source AS key, count(*) / max(n) AS value FROM t, n GROUP BY source
  UNION ALL SELECT 'complexity_share', complexity, count(*) / max(n) FROM t, n GROUP BY complexity
  UNION ALL SELECT 'max_chars', 'all', max(n_chars) FROM t UNION ALL SELECT 'max_tokens', 'all', max(tokens) FROM t
  UNION ALL SELECT 'mean_tokens', 'all', avg(tokens) FROM t UNION ALL SELECT 'ood_share', 'all', avg(CASE WHEN is_ood THEN 1.0 ELSE 0.0 END) FROM t),
rules(metric, side, bound, flag) AS (VALUES {', '.join(f"('{a}', '{b}', {c}::DOUBLE, '{d}')" for a, b, c, d in _FLAGS)})
SELECT flag, metric, key, round(value, 6)::DOUBLE AS value FROM m JOIN rules USING (metric) WHERE CASE side WHEN 'above' THEN value > bound ELSE value < bound END""")
def red_flags(spark, sf):
    size = R.first_match([(F.col("n_chars") > 4000, "complex"), (F.col("n_chars") > 800, "medium")], "simple")
    rows = samples(spark, sf).withColumn("complexity", size).withColumn("tokens", T.est_tokens_words(F.col("text")))
    total = rows.agg(F.count("*")).scalar()
    shares = ST.facet_counts(rows, ["source", "complexity"]).select(
        F.concat("facet", F.lit("_share")).alias("metric"), F.col("value").alias("key"), (F.col("n") / total).alias("value"))
    whole = rows.agg(F.max("n_chars").alias("max_chars"), F.max("tokens").alias("max_tokens"), F.avg("tokens").alias("mean_tokens"),
                     F.avg(F.col("is_ood").cast("double")).alias("ood_share"))
    facts = long_rows(whole, "all").select(F.col("key").alias("metric"), F.col("metric").alias("key"), "value")
    rules = small_table(spark, ("metric", "side", "bound", "flag"), _FLAGS)
    return ST.apply_thresholds(shares.unionByName(facts), rules).withColumn("value", F.round("value", 6))
