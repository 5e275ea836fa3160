"""Evaluation, event and corpus reports."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomset.functions import rules as R
from loomset.functions import text as T
from loomset.functions import vectors as VF
from loomset.functions.masks import MASKS, PROPER, mask_pattern
from loomset.operators import joins as J
from loomset.operators import stats as ST
from loomset.operators import vectors as V
from loomset.operators.ranking import top_n_per_group
from loomset.operators.split import unit_of

from . import sqltext as S
from .joining import SQL_CENTROIDS, SQL_NEGATIVES, SQL_SELF, vecs
from .registry import query, quoted, small_table, table, texts


def sql_mask(text="text"):
    for pattern, name in MASKS:
        text = f"regexp_replace({text}, {quoted(pattern)}, '{name}', 'g')"
    return (f"array_to_string(list_transform({S.words(text)}, lambda w: CASE WHEN regexp_matches(w, {quoted(PROPER)}) "
            "THEN '<PROPER_NOUN>' ELSE lower(w) END), ' ')")


@query("pattern_diversity", f"""
WITH m AS (SELECT lang, md5({sql_mask()}) AS pattern FROM documents),
s AS (SELECT lang, count(*) AS total, count(DISTINCT pattern) AS uniq, round(count(DISTINCT pattern) / count(*), 6) AS ratio FROM m GROUP BY lang),
c AS (SELECT lang, pattern, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, pattern) AS rank FROM m GROUP BY lang, pattern)
SELECT lang, total, uniq, ratio, pattern, n, rank FROM s JOIN c USING (lang) WHERE rank <= 3""")
def pattern_diversity(spark, sf):
    masked = texts(spark, sf).select("lang", F.md5(mask_pattern(F.col("text"))).alias("pattern"))
    counted = masked.groupBy("lang", "pattern").agg(F.count("*").alias("n"))
    whole = counted.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("uniq"))
    top = top_n_per_group(counted, ["lang"], [F.col("n").desc(), F.col("pattern")], 3)
    return whole.withColumn("ratio", F.round(F.col("uniq") / F.col("total"), 6)).join(top, "lang")


SQL_GOLD = f"""{SQL_CENTROIDS},
cs AS (SELECT e.vec_id AS query, e.label::BIGINT AS gold, c.id, list_cosine_similarity(c.vec, e.embedding::DOUBLE[]) AS sim FROM embeddings e, cents c),
combo AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM cs),
gold AS (SELECT query, gold, rank FROM combo WHERE id = gold),
pred AS (SELECT query, gold, id AS pred, sim FROM combo WHERE rank = 1)"""
SQL_ITEM = f"""{SQL_SELF},
item AS (SELECT query, min(CASE WHEN mine = label THEN rank END) AS rank FROM ranked WHERE rank <= 5 GROUP BY query)"""


def sql_metrics(source):
    return (f"SELECT avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS recall_at_1, avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0.0 END)::DOUBLE AS recall_at_3, "
            f"avg(CASE WHEN rank <= 5 THEN 1.0 ELSE 0.0 END)::DOUBLE AS recall_at_5, avg(coalesce(1.0::DOUBLE / rank, 0)) AS mrr FROM {source}")


def combos(spark, sf):
    """Every class mean ranked for every vector, with the vector's own class as ``gold``."""
    rows = vecs(spark, sf)
    ranked = V.full_ranking(rows, V.centroids(rows, "label", "vec"))
    return ranked.join(rows.select(F.col("id").alias("query"), F.col("label").alias("gold")), "query")


def gold_ranks(spark, sf):
    return combos(spark, sf).where("id = gold").select("query", "gold", "rank")


def predicted(spark, sf):
    return combos(spark, sf).where("rank = 1").select("query", "gold", F.col("id").alias("pred"), "sim")


def item_ranks(spark, sf):
    rows = vecs(spark, sf)
    found = V.knn(rows, rows, 5, exclude_self=True).join(rows.select("id", "label"), "id").join(
        rows.select(F.col("id").alias("query"), F.col("label").alias("mine")), "query")
    return found.groupBy("query").agg(F.min(F.when(F.col("mine") == F.col("label"), F.col("rank"))).alias("rank"))


_METRICS = ("recall_at_1", "recall_at_3", "recall_at_5", "mrr")


@query("recall_at_k", f"WITH {SQL_GOLD}, m AS ({sql_metrics('gold')}) SELECT round(recall_at_1, 6) AS recall_at_1, round(recall_at_3, 6) AS recall_at_3, round(recall_at_5, 6) AS recall_at_5 FROM m")
def recall_at_k(spark, sf):
    made = V.recall_and_mrr(gold_ranks(spark, sf))
    return made.select(*[F.round(c, 6).alias(c) for c in _METRICS[:3]])


@query("mrr", f"WITH {SQL_GOLD} SELECT gold, round(avg(1.0::DOUBLE / rank), 6) AS mrr, count(*) AS n FROM gold GROUP BY gold")
def mrr(spark, sf):
    return gold_ranks(spark, sf).groupBy("gold").agg(F.round(F.avg(1.0 / F.col("rank")), 6).alias("mrr"), F.count("*").alias("n"))


@query("gold_rank", f"WITH {SQL_GOLD} SELECT query, gold, rank FROM gold")
def gold_rank(spark, sf):
    return gold_ranks(spark, sf)


@query("classification_report", f"""
WITH {SQL_GOLD}, l AS (SELECT gold AS label FROM pred UNION SELECT pred FROM pred),
c AS (SELECT label, (SELECT count(*) FROM pred WHERE gold = label) AS support, (SELECT count(*) FROM pred WHERE pred = label) AS guessed, (SELECT count(*) FROM pred WHERE pred = label AND gold = label) AS hit FROM l),
p AS (SELECT label, support, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM p)
SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(spark, sf):
    report = ST.classification_report(predicted(spark, sf), "gold", "pred")
    return report.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("memorisation_check", f"""
WITH {SQL_GOLD}, {SQL_ITEM}, a AS ({sql_metrics('gold')}), b AS ({sql_metrics('item')}),
d AS (SELECT a.recall_at_1 - b.recall_at_1 AS d1, a.recall_at_3 - b.recall_at_3 AS d3, a.recall_at_5 - b.recall_at_5 AS d5, a.mrr - b.mrr AS dm FROM a, b)
SELECT round(d1, 6) AS recall_at_1, round(d3, 6) AS recall_at_3, round(d5, 6) AS recall_at_5, round(dm, 6) AS mrr,
  CASE WHEN d1 > 0.2 AND dm > 0.2 THEN 'memorisation' WHEN abs(d1) < 0.1 AND abs(dm) < 0.1 THEN 'balanced' WHEN d1 < -0.1 THEN 'better_items' ELSE 'unclear' END AS verdict
FROM d""")
def memorisation_check(spark, sf):
    a = V.recall_and_mrr(gold_ranks(spark, sf))
    b = V.recall_and_mrr(item_ranks(spark, sf)).select(*[F.col(m).alias(f"item_{m}") for m in _METRICS])
    gap = a.join(b).select(*[(F.col(m) - F.col(f"item_{m}")).alias(m) for m in _METRICS])
    first, rank = F.col("recall_at_1"), F.col("mrr")
    verdict = R.first_match([
        ((first > 0.2) & (rank > 0.2), "memorisation"), ((F.abs(first) < 0.1) & (F.abs(rank) < 0.1), "balanced"),
        (first < -0.1, "better_items")], "unclear")
    return gap.select(*[F.round(m, 6).alias(m) for m in _METRICS], verdict.alias("verdict"))


_SUBSETS = ("minimal", "moderate", "comprehensive")


def _subset() -> Column:
    """Labels below 3 and below 6; everything else is the third subset, without bounds."""
    return R.first_match([(F.col("label") < 3, "minimal"), (F.col("label") < 6, "moderate")], "comprehensive")


@query("subset_accuracy_warnings", f"""
WITH x AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec, CASE WHEN label < 3 THEN 'minimal' WHEN label < 6 THEN 'moderate' ELSE 'comprehensive' END AS subset FROM embeddings),
s AS (SELECT a.subset, a.vec_id, a.label = b.label AS ok, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.vec, b.vec) DESC, b.vec_id) AS rank FROM x a JOIN x b ON a.subset = b.subset AND a.vec_id <> b.vec_id),
acc AS (SELECT subset, count(*) AS n, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy FROM s WHERE rank = 1 GROUP BY subset HAVING count(*) > 10)
SELECT subset, n, round(accuracy, 6) AS accuracy,
  subset = 'minimal' AND accuracy - (SELECT accuracy FROM acc WHERE subset = 'comprehensive') > 0.2 AS warn_gap, accuracy > 0.95 AS warn_high FROM acc""")
def subset_accuracy_warnings(spark, sf):
    rows, parts = vecs(spark, sf), []
    for name in _SUBSETS:
        part = rows.where(_subset() == name)
        near = V.knn(part, part, 1, exclude_self=True).join(part.select("id", "label"), "id").join(
            part.select(F.col("id").alias("query"), F.col("label").alias("mine")), "query")
        parts.append(near.agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("mine")).cast("double")).alias("accuracy")).select(
            F.lit(name).alias("subset"), "n", "accuracy"))
    scored = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("n > 10")
    hard = scored.where("subset = 'comprehensive'").agg(F.max("accuracy")).scalar()
    return scored.select(
        "subset", "n", F.round("accuracy", 6).alias("accuracy"),
        ((F.col("subset") == "minimal") & (F.col("accuracy") - hard > 0.2)).alias("warn_gap"),
        (F.col("accuracy") > 0.95).alias("warn_high"))


@query("error_by_template", f"""
WITH {SQL_GOLD}, t AS (SELECT gold AS template, count(*) AS total, count(*) FILTER (gold = pred) AS correct FROM pred GROUP BY gold),
e AS (SELECT gold AS template, query, pred, row_number() OVER (PARTITION BY gold ORDER BY query) AS rank FROM pred WHERE gold <> pred)
SELECT template, total, correct, query, pred, rank FROM t JOIN e USING (template) WHERE rank <= 3""")
def error_by_template(spark, sf):
    rows = predicted(spark, sf).withColumn("template", F.col("gold"))
    whole = rows.groupBy("template").agg(F.count("*").alias("total"), F.count_if(F.col("gold") == F.col("pred")).alias("correct"))
    errors = top_n_per_group(rows.where("gold <> pred").select("template", "query", "pred"), ["template"], [F.col("query")], 3)
    return whole.join(errors, "template")


@query("pair_accuracy", f"""
WITH {SQL_NEGATIVES},
r AS (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings),
pos AS (SELECT x.id AS a, y.id AS b, 1 AS gold FROM r x JOIN r y ON x.label = y.label AND y.r BETWEEN x.r + 1 AND x.r + 2),
neg AS (SELECT query AS a, id AS b, 0 AS gold FROM negatives),
s AS (SELECT gold, list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) > 0.05 AS guess FROM (SELECT * FROM pos UNION ALL SELECT * FROM neg) p JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b)
SELECT gold::BIGINT AS gold, count(*) AS n, round(avg(CASE WHEN guess = (gold = 1) THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy FROM s GROUP BY gold""")
def pair_accuracy(spark, sf):
    rows = vecs(spark, sf)
    pos = J.window_pairs(rows, "id", "label", F.shiftright(F.col("id"), 16)).select("a", "b", F.lit(1).cast("long").alias("gold"))
    neg = J.negative_pairs(rows, "id", "label", 3).select("a", "b", F.lit(0).cast("long").alias("gold"))
    x, y = (rows.select(F.col("id").alias(k), F.col("vec").alias(f"v{k}")) for k in "ab")
    scored = pos.unionByName(neg).join(x, "a").join(y, "b").withColumn("guess", VF.cosine(F.col("va"), F.col("vb")) > 0.05)
    right = (F.col("guess") == (F.col("gold") == 1)).cast("double")
    return scored.groupBy("gold").agg(F.count("*").alias("n"), F.round(F.avg(right), 6).alias("accuracy"))


@query("inverse_freq_weight", """
WITH c AS (SELECT source || '|' || lang AS combo, count(*) AS n FROM documents GROUP BY 1)
SELECT combo, n, round((SELECT sum(n) FROM c) / (n * (SELECT count(*) FROM c))::DOUBLE, 6) AS weight FROM c""")
def inverse_freq_weight(spark, sf):
    rows = table(spark, sf, "documents").select(F.concat_ws("|", "source", "lang").alias("combo"))
    return ST.inverse_freq_weight(rows, "combo").withColumn("weight", F.round("weight", 6))


@query("weighted_sample", """
WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), w AS (SELECT lang, n, (SELECT sum(n) FROM c)::DOUBLE / (n * (SELECT count(*) FROM c)) AS weight FROM c),
d AS (SELECT doc_id, lang, -ln(CAST('0x' || substr(md5('42|' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) / weight AS draw FROM documents JOIN w USING (lang))
SELECT doc_id, lang, round(draw, 6) AS draw FROM d ORDER BY d.draw, doc_id LIMIT 100""")
def weighted_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    rows = docs.join(ST.inverse_freq_weight(docs, "lang"), "lang")
    drawn = ST.weighted_sample(rows, "doc_id", "weight", unit_of(F.col("doc_id")), 100)
    return drawn.select("doc_id", "lang", F.round("draw", 6).alias("draw"))


@query("mapping_summary", """
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) // 25 AS failure_type, user_id AS reason, event_type = 'error' AS failed FROM events),
s AS (SELECT avg(CASE WHEN failed THEN 0.0 ELSE 1.0 END)::DOUBLE AS rate FROM e), t AS (SELECT failure_type, count(*) AS failures FROM e WHERE failed GROUP BY 1),
r AS (SELECT failure_type, reason, count(*) AS n, row_number() OVER (PARTITION BY failure_type ORDER BY count(*) DESC, reason) AS rank FROM e WHERE failed GROUP BY 1, 2)
SELECT failure_type, failures, reason, n, rank, round(rate, 6) AS success_rate FROM r JOIN t USING (failure_type), s WHERE rank <= 3""")
def mapping_summary(spark, sf):
    kind = F.floor(F.get_json_object("props", "$.k").cast("long") / 25)
    rows = table(spark, sf, "events").select(kind.alias("failure_type"), F.col("user_id").alias("reason"), (F.col("event_type") == "error").alias("failed"))
    rate = rows.agg(F.round(F.avg((~F.col("failed")).cast("double")), 6)).scalar()
    counted = rows.where("failed").groupBy("failure_type", "reason").agg(F.count("*").alias("n"))
    whole = counted.groupBy("failure_type").agg(F.sum("n").alias("failures"))
    top = top_n_per_group(counted, ["failure_type"], [F.col("n").desc(), F.col("reason")], 3)
    return top.join(whole, "failure_type").withColumn("success_rate", rate)


@query("error_stats_24h", """
WITH r AS (SELECT *, CASE WHEN value > 80 THEN 'critical' WHEN value > 50 THEN 'high' WHEN value > 20 THEN 'medium' ELSE 'low' END AS severity,
           CAST(json_extract(props, '$.k') AS BIGINT) >= 50 AS recovered FROM events WHERE ts > TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-25 00:00:00')
SELECT 'category' AS metric, event_type AS key, count(*)::DOUBLE AS value FROM r GROUP BY 2
UNION ALL SELECT 'severity', severity, count(*)::DOUBLE FROM r GROUP BY 2
UNION ALL SELECT 'total', 'errors_24h', count(*)::DOUBLE FROM r UNION ALL SELECT 'total', 'rate_per_hour', round(count(*) / 24.0::DOUBLE, 6) FROM r
UNION ALL SELECT 'total', 'recovery_rate', round(count(*) FILTER (recovered) / greatest(1, count(*))::DOUBLE, 6) FROM r""")
def error_stats_24h(spark, sf):
    now, v = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"), F.col("value")
    severity = R.first_match([(v > 80, "critical"), (v > 50, "high"), (v > 20, "medium")], "low")
    recent = table(spark, sf, "events").where((F.col("ts") > now - F.expr("INTERVAL '24' HOUR")) & (F.col("ts") <= now)).select(
        F.col("event_type").alias("category"), severity.alias("severity"),
        (F.get_json_object("props", "$.k").cast("long") >= 50).alias("recovered"))
    parts = ST.facet_counts(recent, ["category", "severity"]).select(
        F.col("facet").alias("metric"), F.col("value").alias("key"), F.col("n").cast("double").alias("value"))
    n = F.count("*")
    whole = recent.agg(n.alias("errors_24h"), F.round(n / 24.0, 6).alias("rate_per_hour"),
                       F.round(F.count_if("recovered") / F.greatest(F.lit(1), n), 6).alias("recovery_rate"))
    return parts.unionByName(ST.long_rows(whole, "total"))


@query("latency_percentiles", """
SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.95), 6) AS p95, avg(value) < 50 AND quantile_cont(value, 0.95) < 95 AS within_limits FROM events GROUP BY event_type""")
def latency_percentiles(spark, sf):
    rows = table(spark, sf, "events").select("event_type", "value")
    tail = ST.exact_percentiles(rows, "value", {"p95": 0.95}, ["event_type"])
    mean = rows.groupBy("event_type").agg(F.avg("value").alias("mean"))
    return mean.join(tail, "event_type").select(
        "event_type", F.round("mean", 6).alias("mean"), F.round("p95", 6).alias("p95"),
        ((F.col("mean") < 50) & (F.col("p95") < 95)).alias("within_limits"))


@query("run_success_rate", """
SELECT user_id, count(*) AS total, CAST(round(100.0 * count(*) FILTER (event_type <> 'error') / count(*)) AS BIGINT) AS percent FROM events GROUP BY user_id""")
def run_success_rate(spark, sf):
    good = F.count_if(F.col("event_type") != "error")
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.count("*").alias("total"), F.round(100.0 * good / F.count("*")).cast("long").alias("percent"))


@query("count_by_type", "SELECT event_type AS type, count(*) AS n FROM events GROUP BY 1")
def count_by_type(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("type")).agg(F.count("*").alias("n"))


@query("corpus_stats", f"""
WITH d AS (SELECT length(text) AS chars, {S.word_count()} AS words, greatest(CAST(ceil({S.est_tokens()} / 480.0) AS BIGINT), 1) AS chunks FROM documents)
SELECT min(chars)::BIGINT AS min_chars, max(chars)::BIGINT AS max_chars, round(avg(chars), 6) AS mean_chars, CAST(sum(chars) AS BIGINT) AS total_chars,
       min(words) AS min_words, max(words) AS max_words, round(avg(words), 6) AS mean_words, CAST(sum(words) AS BIGINT) AS total_words,
       count(*) FILTER (chunks = 1) AS one_chunk, count(*) FILTER (chunks = 2) AS two_chunks, count(*) FILTER (chunks >= 3) AS more_chunks,
       round(count(*) FILTER (chunks > 1) / count(*), 6) AS chunking_rate FROM d""")
def corpus_stats(spark, sf):
    text = F.col("text")
    rows = texts(spark, sf).select(F.length(text).cast("long").alias("chars"), T.word_count(text).alias("words"))
    rows = rows.withColumn("chunks", F.greatest(F.ceil(F.floor(F.col("words") * 1.33) / 480.0), F.lit(1)))
    sides = [f(c).alias(f"{n}_{c}") for c in ("chars", "words") for n, f in (("min", F.min), ("max", F.max), ("total", F.sum))]
    means = [F.round(F.avg(c), 6).alias(f"mean_{c}") for c in ("chars", "words")]
    c = F.col("chunks")
    return rows.agg(*sides, *means, F.count_if(c == 1).alias("one_chunk"), F.count_if(c == 2).alias("two_chunks"),
                    F.count_if(c >= 3).alias("more_chunks"), F.round(F.count_if(c > 1) / F.count("*"), 6).alias("chunking_rate"))


# class 99 is on the list but gets nothing
@query("route_summary", f"""
WITH {SQL_GOLD}, l AS (SELECT id FROM cents UNION ALL SELECT 99), n AS (SELECT count(*) AS total FROM pred),
s AS (SELECT l.id AS class, count(query) AS n, coalesce(avg(sim), 0) AS confidence FROM l LEFT JOIN pred ON pred = l.id GROUP BY 1)
SELECT class, n, round(100.0 * n / total, 6)::DOUBLE AS percent, round(confidence, 6) AS mean_confidence, class = (SELECT class FROM s ORDER BY n DESC, class LIMIT 1) AS dominant FROM s, n""")
def route_summary(spark, sf):
    rows = predicted(spark, sf)
    classes = vecs(spark, sf).select(F.col("label").alias("class")).distinct().unionByName(small_table(spark, ("class",), [(99,)]).select(F.col("class").cast("long")))
    counted = rows.groupBy(F.col("pred").alias("class")).agg(F.count("*").alias("n"), F.avg("sim").alias("confidence"))
    full = classes.join(counted, "class", "left").fillna(0, ["n"]).fillna(0.0, ["confidence"])
    total, top = counted.agg(F.sum("n")).scalar(), counted.agg(F.min_by("class", F.struct(-F.col("n"), "class"))).scalar()
    return full.select("class", "n", F.round(100.0 * F.col("n") / total, 6).alias("percent"),
                       F.round("confidence", 6).alias("mean_confidence"), (F.col("class") == top).alias("dominant"))


@query("retry_quality_report", f"""
WITH d AS (SELECT {S.est_tokens()} AS tokens, {S.word_count()} AS words, coalesce(l.quality, 1) AS quality, {S.is_valid_text()} AS valid FROM documents LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS attempts, round(avg(CASE WHEN tokens <= 512 AND quality = 1 AND valid THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS success_rate,
       count(*) FILTER (tokens > 512) AS token_failures, count(*) FILTER (quality = 0) AS coherence_failures, count(*) FILTER (NOT valid) AS field_failures,
       {', '.join(f"round(avg({c}), 6) AS mean_{n}, round(stddev_pop({c}), 4) AS std_{n}, min({c}) AS min_{n}, max({c}) AS max_{n}" for c, n in (("tokens", "tokens"), ("words", "words"), ("quality", "score")))} FROM d""")
def retry_quality_report(spark, sf):
    text = F.col("text")
    rows = texts(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").select(
        T.est_tokens_words(text).alias("tokens"), T.word_count(text).alias("words"),
        F.coalesce("quality", F.lit(1)).alias("quality"), T.is_valid_text(text).alias("valid"))
    good = (F.col("tokens") <= 512) & (F.col("quality") == 1) & F.col("valid")
    spread = [
        made.alias(f"{kind}_{name}")
        for c, name in (("tokens", "tokens"), ("words", "words"), ("quality", "score"))
        for kind, made in (("mean", F.round(F.avg(c), 6)), ("std", F.round(F.stddev_pop(c), 4)), ("min", F.min(c)), ("max", F.max(c)))]
    return rows.agg(
        F.count("*").alias("attempts"), F.round(F.avg(good.cast("double")), 6).alias("success_rate"),
        F.count_if(F.col("tokens") > 512).alias("token_failures"), F.count_if(F.col("quality") == 0).alias("coherence_failures"),
        F.count_if(~F.col("valid")).alias("field_failures"), *spread)


def components_of(df, k: int):
    """Rows (id, p) of projections on the first ``k`` principal directions, and the directions' shares of the variance."""
    rows = df.select("id", array_to_vector(F.col("vec").cast("array<double>")).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows)
    return model.transform(rows).select("id", vector_to_array("p").alias("p")), model.explainedVariance.toArray().tolist()


def sql_components(k: int) -> str:
    """The first ``k`` principal directions as projectors, by squaring the covariance matrix and taking each one off.

    24 squarings are the 2**24-th power, in which the largest direction is all that is left.
    """
    return f"""
dims AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
cov AS (SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS c FROM dims a JOIN dims b USING (vec_id) GROUP BY 1, 2),
lines AS (SELECT i, list(c ORDER BY j) AS r FROM cov GROUP BY i),
start AS (SELECT list(r ORDER BY i) AS c, CAST(sum(r[i]) AS DOUBLE) AS whole FROM lines),
walk AS (
  SELECT 1 AS n, 0 AS step, c, c AS m, whole, 0.0::DOUBLE AS value FROM start
  UNION ALL
  SELECT CASE WHEN step < 24 THEN n ELSE n + 1 END, CASE WHEN step < 24 THEN step + 1 ELSE 0 END,
         CASE WHEN step < 24 THEN c ELSE rest END,
         CASE WHEN step < 24 THEN list_transform(m, lambda r: list_transform(m, lambda s: list_inner_product(r, s) / size)) ELSE rest END, whole, value
  FROM (
    SELECT *, CASE WHEN step = 24 THEN list_transform(range(1, len(c) + 1), lambda i: list_transform(range(1, len(c) + 1), lambda j: c[i][j] - value * m[i][j])) ELSE c END AS rest
    FROM (
      SELECT n, step, c, m, whole, list_sum(list_transform(m, lambda r: list_inner_product(r, r))) AS size,
             list_sum(list_transform(range(1, len(c) + 1), lambda i: list_inner_product(c[i], m[i]))) AS value
      FROM walk WHERE n <= {k})) t),
main AS (
  SELECT n, m, list_sum(list_transform(range(1, len(c) + 1), lambda i: list_inner_product(c[i], m[i]))) / whole AS share
  FROM walk WHERE step = 24 AND n <= {k}),
projected AS (
  SELECT vec_id, n, share, list_inner_product(e, list_transform(m, lambda r: list_inner_product(r, e))) AS square
  FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), main)"""


# the sign of a direction is free, so lengths and shares are reported
@query("pca_2d", f"""
WITH RECURSIVE {sql_components(2)}
SELECT vec_id, round(sqrt(max(square) FILTER (n = 1)), 6) AS x, round(sqrt(max(square) FILTER (n = 2)), 6) AS y,
       round(max(share) FILTER (n = 1), 6) AS share_x, round(max(share) FILTER (n = 2), 6) AS share_y
FROM projected GROUP BY vec_id""")
def pca_2d(spark, sf):
    made, (x, y) = components_of(vecs(spark, sf), 2)
    return made.select(
        F.col("id").alias("vec_id"), F.round(F.abs(F.col("p")[0]), 6).alias("x"), F.round(F.abs(F.col("p")[1]), 6).alias("y"),
        F.round(F.lit(x), 6).alias("share_x"), F.round(F.lit(y), 6).alias("share_y"))


@query("pca_50d", f"""
WITH RECURSIVE {sql_components(50)}
SELECT vec_id, round(sqrt(sum(square)), 5) AS length, 50 AS dims, round(sum(share), 6) AS share FROM projected GROUP BY vec_id""")
def pca_50d(spark, sf):
    made, shares = components_of(vecs(spark, sf), 50)
    return made.select(
        F.col("id").alias("vec_id"), F.round(VF.norm(F.col("p")), 5).alias("length"), F.size("p").alias("dims"), F.round(F.lit(sum(shares)), 6).alias("share"))
