"""Joins: near duplicates, lookups, search, pairs and negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.functions import patterns as P
from loomset.functions import text as T
from loomset.operators import graphs as G
from loomset.operators import joins as J
from loomset.operators import neardup as N
from loomset.operators import vectors as V
from loomset.operators.ranking import digest
from loomset.session import written_table

from . import sqltext as S
from .registry import query, quoted, small_table, table, texts
from .views import samples, split_of

NEAR = 0.4  # the driver vectors hold no pair at 0.95


def vecs(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").cast("long").alias("label")
    )


SQL_REPS = """
reps AS (SELECT min(vec_id) AS id, embedding::DOUBLE[] AS vec FROM embeddings GROUP BY embedding),
copies AS (SELECT min(vec_id) OVER (PARTITION BY embedding) AS rep, vec_id AS id FROM embeddings)"""
SQL_VEC_PAIRS = f"""{SQL_REPS},
pairs AS (
  SELECT a.id AS a, b.id AS b, list_cosine_similarity(a.vec, b.vec) AS sim FROM reps a JOIN reps b ON a.id < b.id
  WHERE list_cosine_similarity(a.vec, b.vec) >= {NEAR}
  UNION ALL SELECT rep, id, 1.0 FROM copies WHERE rep <> id)"""


# every pair of rows; a vector without length is like its copies only
@query("near_dup_pairs", f"""
WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
pairs AS (SELECT a.id AS a, b.id AS b, CASE WHEN a.vec = b.vec THEN 1.0 ELSE list_cosine_similarity(a.vec, b.vec) END AS sim FROM v a JOIN v b ON a.id < b.id)
SELECT a, b, round(sim, 6) AS sim FROM pairs WHERE sim >= {NEAR} AND NOT isnan(sim)""")
def near_dup_pairs(spark, sf):
    found = V.near_dup_pairs(vecs(spark, sf), "id", "vec", NEAR, every_copy=True)
    return found.select("a", "b", F.round("sim", 6).alias("sim"))


# approximate by design: its pairs are a subset of near_dup_pairs, so rows only
@query("near_dup_pairs_banded")
def near_dup_pairs_banded(spark, sf):
    return V.near_dup_pairs_banded(vecs(spark, sf), "id", "vec", 64, NEAR, bands=24, bits=6)


def sql_text_pairs(threshold: float) -> str:
    return f"""
reps AS (SELECT min(doc_id) AS id, text FROM documents GROUP BY text),
toks AS (SELECT id, {S.tokens()} AS t FROM reps),
shingled AS (SELECT id, list_distinct(list_transform(range(1, greatest(len(t) - 2, 1) + 1), lambda i: array_to_string(list_slice(t, i, i + 2), ' '))) AS s FROM toks),
listed AS (SELECT id, len(s) AS n, unnest(s) AS item FROM shingled),
shared AS (SELECT x.id AS a, y.id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM listed x JOIN listed y ON x.item = y.item AND x.id < y.id GROUP BY ALL),
text_pairs AS (
  SELECT a, b, c / (na + nb - c) AS jaccard FROM shared WHERE c / (na + nb - c) >= {threshold}
  UNION ALL SELECT rep, doc_id, 1.0 FROM (SELECT min(doc_id) OVER (PARTITION BY text) AS rep, doc_id FROM documents) WHERE rep <> doc_id)"""


@query("near_dup_text_pairs", f"WITH {sql_text_pairs(0.7)} SELECT a, b, round(jaccard, 6) AS jaccard FROM text_pairs")
def near_dup_text_pairs(spark, sf):
    found = N.near_dup_text_pairs(texts(spark, sf), "doc_id", "text", 0.7)
    return found.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("clean_anti", """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (
  SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1)""")
def clean_anti(spark, sf):
    docs = table(spark, sf, "documents")
    _, links = N.distinct_texts(docs, "doc_id", "text")
    return J.clean_anti(docs, links.select(F.col("id").alias("doc_id")), "doc_id").select("doc_id", "lang")


@query("split_semi", f"""
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM documents WHERE {S.split_of()} = 'val')""")
def split_semi(spark, sf):
    docs = table(spark, sf, "documents")
    members = docs.select("doc_id").where(split_of(F.col("doc_id")) == "val")
    return J.split_semi(docs, members, "doc_id").select("doc_id", "lang")


# split lists cover labelled documents only; a document in two lists gets the first
@query("sample_split_lookup", f"""
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unknown' WHEN l.toxic = 1 THEN 'train' ELSE {S.split_of('d.doc_id')} END AS split
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def sample_split_lookup(spark, sf):
    scored = table(spark, sf, "labels")
    members = scored.select("doc_id", split_of(F.col("doc_id")).alias("split")).unionByName(
        scored.where("toxic = 1").select("doc_id", F.lit("train").alias("split")))
    found = J.first_split(members, "doc_id")
    return J.lookup_default(table(spark, sf, "documents").select("doc_id"), found, "doc_id", {"split": "unknown"})


@query("dim_lookup_default", """
SELECT s_suppkey, coalesce(n_name, 'other') AS nation, coalesce(r_name, 'unknown') AS region
FROM supplier LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') ON s_nationkey = n_nationkey""")
def dim_lookup_default(spark, sf):
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = nations.where("r_name <> 'ASIA'").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    rows = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("key"))
    return J.lookup_default(rows, dim, "key", {"nation": "other", "region": "unknown"}).drop("key")


# brand = part brand, industry = part type; the home type of a brand is the smallest one it has in size 1 to 10
_HOME = "SELECT p_brand AS brand, min(p_type) AS home_industry FROM part WHERE p_size <= 10 GROUP BY p_brand"
_FITS = [("ECONOMY", "ECONOMY"), ("ECONOMY", "STANDARD"), ("LARGE", "LARGE"), ("MEDIUM", "MEDIUM"), ("PROMO", "PROMO"),
         ("SMALL", "SMALL"), ("STANDARD", "STANDARD"), ("STANDARD", "ECONOMY"), ("BURNISHED", "BURNISHED")]


@query("compat_check", f"""
WITH home AS ({_HOME}),
fits(home_industry, industry) AS (VALUES {', '.join(f"({quoted(a)}, {quoted(b)})" for a, b in _FITS)}),
bad AS (SELECT DISTINCT p_brand AS brand, p_type AS industry FROM part WHERE p_size >= 45),
judged AS (
  SELECT p_partkey, p_type, h.home_industry, b.brand IS NOT NULL AS impossible, f.industry IS NOT NULL AS fits
  FROM part p LEFT JOIN home h ON p.p_brand = h.brand LEFT JOIN bad b ON p.p_brand = b.brand AND p.p_type = b.industry
  LEFT JOIN fits f ON f.home_industry = h.home_industry AND f.industry = p.p_type),
v AS (SELECT *, NOT impossible AND (home_industry IS NULL OR fits) AS valid FROM judged)
SELECT p_partkey, valid, CASE WHEN home_industry = p_type THEN 0.95::DOUBLE WHEN valid THEN 0.85 WHEN NOT impossible THEN 0.7 ELSE 0.25 END AS confidence,
       CASE WHEN valid OR home_industry IS NULL THEN p_type ELSE home_industry END AS corrected_industry
FROM v""")
def compat_check(spark, sf):
    part = table(spark, sf, "part")
    home = part.where("p_size <= 10").groupBy(F.col("p_brand").alias("brand")).agg(F.min("p_type").alias("home_industry"))
    bad = part.where("p_size >= 45").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("industry")).distinct()
    fits = small_table(spark, ("home_industry", "industry"), _FITS)
    rows = part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("industry"))
    return J.compat_check(rows, home, fits, bad).select("p_partkey", "valid", "confidence", "corrected_industry")


SQL_CENTROIDS = """
dims AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label::BIGINT AS label, pos, avg(x) AS x FROM dims GROUP BY label, pos),
cents AS (SELECT label AS id, list(x ORDER BY pos) AS vec FROM means GROUP BY label)"""


# every class mean asks; the rows of class 9 count as deleted
@query("knn_search", f"""
WITH {SQL_CENTROIDS},
scored AS (SELECT c.id AS query, e.vec_id AS id, list_cosine_similarity(c.vec, e.embedding::DOUBLE[]) AS sim
           FROM cents c, embeddings e WHERE e.label <> 9),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM scored)
SELECT query, id, round(sim, 6) AS sim, rank FROM ranked WHERE rank <= 5""")
def knn_search(spark, sf):
    rows = vecs(spark, sf)
    live = rows.where("label <> 9")
    return V.knn(V.centroids(rows, "label", "vec"), live, 5).withColumn("sim", F.round("sim", 6))


SQL_SELF = """
scored AS (SELECT a.vec_id AS query, b.vec_id AS id, a.label AS mine, b.label AS label,
                  list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM scored)"""


@query("knn_fallback", f"""
WITH {SQL_CENTROIDS}, {SQL_SELF},
main AS (SELECT query, id, sim FROM ranked WHERE rank = 1),
sig AS (SELECT e.vec_id AS query, c.id, list_cosine_similarity(c.vec, e.embedding::DOUBLE[]) AS sim FROM embeddings e, cents c),
bones AS (SELECT query, id, sim FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM sig) WHERE rank = 1)
SELECT m.query, CASE WHEN m.sim >= 0.3 THEN 'main' WHEN b.sim >= 0.25 THEN 'signature' ELSE 'emergency' END AS answered_by,
       CASE WHEN m.sim >= 0.3 THEN m.id WHEN b.sim >= 0.25 THEN b.id ELSE -1 END AS answer
FROM main m JOIN bones b USING (query)""")
def knn_fallback(spark, sf):
    rows = vecs(spark, sf)
    main = V.knn(rows, rows, 1, exclude_self=True).select("query", F.col("id").alias("main"), F.col("sim").alias("main_sim"))
    bones = V.knn(rows, V.centroids(rows, "label", "vec"), 1).select("query", F.col("id").alias("bone"), F.col("sim").alias("bone_sim"))
    sure, known = F.col("main_sim") >= 0.3, F.col("bone_sim") >= 0.25
    return rows.select(F.col("id").alias("query")).join(main, "query", "left").join(bones, "query", "left").select(
        "query",
        F.when(sure, "main").when(known, "signature").otherwise("emergency").alias("answered_by"),
        F.coalesce(F.when(sure, F.col("main")), F.when(known, F.col("bone")), F.lit(-1).cast("long")).alias("answer"),
    )


@query("combo_rank", f"""
WITH {SQL_CENTROIDS},
scored AS (SELECT e.vec_id AS query, c.id, list_cosine_similarity(c.vec, e.embedding::DOUBLE[]) AS sim FROM embeddings e, cents c)
SELECT query, id, round(sim, 6) AS sim, row_number() OVER (PARTITION BY query ORDER BY sim DESC, id) AS rank FROM scored""")
def combo_rank(spark, sf):
    rows = vecs(spark, sf)
    return V.full_ranking(rows, V.centroids(rows, "label", "vec")).withColumn("sim", F.round("sim", 6))


@query("item_self_retrieval", f"""
WITH {SQL_SELF}
SELECT query, bool_or(mine = label) AS hit, CAST(min(CASE WHEN mine = label THEN rank END) AS BIGINT) AS first_hit
FROM ranked WHERE rank <= 5 GROUP BY query""")
def item_self_retrieval(spark, sf):
    rows = vecs(spark, sf)
    found = V.knn(rows, rows, 5, exclude_self=True).join(rows.select("id", "label"), "id").join(
        rows.select(F.col("id").alias("query"), F.col("label").alias("mine")), "query")
    same = F.col("mine") == F.col("label")
    return found.groupBy("query").agg(F.bool_or(same).alias("hit"), F.min(F.when(same, F.col("rank"))).alias("first_hit"))


@query("nn_label_predict", f"""
WITH {SQL_SELF}, sizes AS (SELECT count(*) AS n, count(DISTINCT label) AS c FROM embeddings)
SELECT n AS rows, CASE WHEN n < 5 THEN 0.0 WHEN c < 2 THEN 0.5 ELSE (SELECT round(avg(CASE WHEN mine = label THEN 1.0 ELSE 0.0 END), 6) FROM ranked WHERE rank = 1) END::DOUBLE AS accuracy
FROM sizes""")
def nn_label_predict(spark, sf):
    rows = vecs(spark, sf)
    near = V.knn(rows, rows, 1, exclude_self=True).join(rows.select("id", "label"), "id").join(
        rows.select(F.col("id").alias("query"), F.col("label").alias("mine")), "query")
    hits = near.agg(F.sum((F.col("label") == F.col("mine")).cast("long"))).scalar()
    sizes = rows.agg(F.count("*").alias("rows"), F.countDistinct("label").alias("c"))
    return sizes.select(
        "rows", F.when(F.col("rows") < 5, 0.0).when(F.col("c") < 2, 0.5).otherwise(F.round(hits / F.col("rows"), 6)).alias("accuracy"))


# all rows in one order, class by class; the j-th row of another class stands j places after the own class, cyclically
SQL_PLACED = """
sized AS (SELECT label, count(*) AS size, md5('42|' || CAST(label AS VARCHAR)) AS h FROM embeddings WHERE label IS NOT NULL GROUP BY label),
ranges AS (SELECT label, size, CAST(sum(size) OVER (ORDER BY h, label) AS BIGINT) - size AS start, CAST(sum(size) OVER () AS BIGINT) AS total FROM sized),
placed AS (
  SELECT vec_id AS id, label, start, size, total, total - size AS others,
         start + row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS place,
         CAST('0x' || substr(md5('negative|' || CAST(vec_id AS VARCHAR)), 1, 15) AS BIGINT) AS drawn
  FROM embeddings JOIN ranges USING (label))"""


def sql_others(asking: str, count: int) -> str:
    """(query, id, own, other, slot): ``count`` rows of any other class for each row of ``asking``."""
    return f"""
  SELECT p.id AS query, t.id, p.label AS own, t.label AS other, s.slot
  FROM {asking} p, range({count}) s(slot) JOIN placed t
    ON t.place = (p.start + p.size + (p.drawn % greatest(p.others, 1) + s.slot * greatest(1, p.others // {count})) % greatest(p.others, 1)) % p.total
  WHERE s.slot < p.others"""


@query("hard_negatives", f"""
WITH {SQL_SELF}, {SQL_PLACED},
drawn_rows AS ({sql_others('placed', 4)}),
spread AS (SELECT query, id, CASE WHEN slot < 1 THEN 0 ELSE 2 END AS tier, slot::DOUBLE AS key FROM drawn_rows),
near AS (SELECT query, id, 1 AS tier, rank::DOUBLE AS key FROM ranked WHERE rank <= 50 AND label <> mine),
once AS (SELECT query, id, min(tier * 1000 + key) AS o FROM (SELECT * FROM spread UNION ALL SELECT * FROM near) GROUP BY query, id),
r AS (SELECT query, id, CAST(floor(o / 1000) AS INTEGER) AS tier, row_number() OVER (PARTITION BY query ORDER BY o, id) AS rank FROM once)
SELECT query, id, tier, rank FROM r WHERE rank <= 3""")
def hard_negatives(spark, sf):
    return J.hard_negatives(vecs(spark, sf), "id", "label", "vec", 3, 50)


# combos = sources, over distinct pairs of text and source
@query("jaccard_negatives", f"""
WITH reps AS (SELECT min(doc_id) AS id, source AS combo, text FROM documents GROUP BY text, source),
listed AS (SELECT id, combo, len(s) AS n, unnest(s) AS item FROM (SELECT id, combo, list_distinct({S.words('lower(text)')}) AS s FROM reps)),
shared AS (SELECT x.id AS a, y.id AS b, x.combo AS ca, y.combo AS cb, x.n AS na, y.n AS nb, count(*) AS c FROM listed x JOIN listed y ON x.item = y.item AND x.id < y.id GROUP BY ALL)
SELECT a, b, round(c / (na + nb - c), 6) AS jaccard FROM shared WHERE c / (na + nb - c) > 0.3 AND ca <> cb""")
def jaccard_negatives(spark, sf):
    docs = texts(spark, sf).select(F.col("doc_id").alias("id"), F.col("source").alias("combo"), "text")
    keyed = docs.select("id", "combo", F.sha2("text", 256).alias("k"))
    first = keyed.groupBy("k", "combo").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = written_table(keyed.join(first, ["k", "combo"]).where("id <> first").select("id"), "later")
    sets = docs.join(N.sent(later), "id", "left_anti").select("id", "combo", N.word_set(F.col("text")).alias("items"))
    pairs = N.jaccard_pairs(sets, 0.3, other_than="combo").where("jaccard > 0.3")
    return pairs.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("positive_pairs_window", """
WITH r AS (SELECT vec_id, label::BIGINT AS label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings)
SELECT 'window' AS kind, x.vec_id AS a, y.vec_id AS b, x.label FROM r x JOIN r y ON x.label = y.label AND y.rn BETWEEN x.rn + 1 AND x.rn + 2
UNION ALL
SELECT 'head', x.vec_id, y.vec_id, x.label FROM r x JOIN r y ON x.label = y.label AND x.rn <= 10 AND y.rn <= 10 AND x.vec_id < y.vec_id""")
def positive_pairs_window(spark, sf):
    rows = vecs(spark, sf)
    near = J.window_pairs(rows, "id", "label", F.shiftright(F.col("id"), 16)).withColumn("kind", F.lit("window"))
    head = J.head_pairs(rows, "id", "label", 10).withColumn("kind", F.lit("head"))
    return near.unionByName(head)


SQL_NEGATIVES = f"""{SQL_PLACED},
heads AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS r FROM placed) WHERE r <= 3),
negatives AS ({sql_others('heads', 1)})"""


@query("negative_pairs", f"WITH {SQL_NEGATIVES} SELECT query AS a, id AS b, own::BIGINT AS label, other::BIGINT AS other FROM negatives")
def negative_pairs(spark, sf):
    return J.negative_pairs(vecs(spark, sf), "id", "label", 3)


@query("cross_split_similarity", f"""
WITH u AS (SELECT vec_id AS id, {S.split_of('vec_id')} AS split, embedding::DOUBLE[] AS vec FROM embeddings),
s AS (SELECT b.split, a.id AS train_id, b.id AS other_id, list_cosine_similarity(a.vec, b.vec) AS sim
      FROM u a JOIN u b ON a.split = 'train' AND b.split <> 'train')
SELECT split, round(max(sim), 6) AS max_sim, arg_max(train_id, sim) AS train_id, arg_max(other_id, sim) AS other_id, round(avg(sim), 6) AS mean_sim
FROM s GROUP BY split""")
def cross_split_similarity(spark, sf):
    rows = vecs(spark, sf).withColumn("split", split_of(F.col("id")))
    train, parts = rows.where("split = 'train'"), []
    for split in ("val", "test"):
        other = rows.where(F.col("split") == split)
        best = V.best_match(V.knn(other, train, 1).withColumn("split", F.lit(split)), ["split"])
        mean = V.mean_similarity(train, other).withColumn("split", F.lit(split))
        parts.append(best.join(mean, "split").select(
            "split", F.round("sim", 6).alias("max_sim"), F.col("id").alias("train_id"), F.col("query").alias("other_id"),
            F.round("mean_sim", 6).alias("mean_sim")))
    return parts[0].unionByName(parts[1])


def _spoken(df, text="text"):
    # white space is squeezed once a text: no run of it holds the end of a sentence
    return df.select(F.explode(F.split(T.squeeze(F.col(text)), P.SENTENCE_END, -1)).alias("s")).select(
        F.trim("s").alias("sentence")).where("sentence <> ''")


def _sentences(df, text="text"):
    return _spoken(df, text).distinct()


SQL_SENTENCES = "SELECT DISTINCT sentence FROM (SELECT {squeezed} AS sentence FROM (SELECT unnest(string_split_regex(text, '[.!?]+')) AS s FROM {table})) WHERE sentence <> ''"


@query("template_overlap", f"""
WITH train AS ({SQL_SENTENCES.format(squeezed=S.squeeze('s'), table='documents')}),
hold AS ({SQL_SENTENCES.format(squeezed=S.squeeze('s'), table='benchmark')})
SELECT sentence, CASE WHEN sentence IN (SELECT sentence FROM train) THEN 'overlap' ELSE 'holdout_only' END AS status FROM hold""")
def template_overlap(spark, sf):
    hold = _sentences(table(spark, sf, "benchmark"))
    # one pass over the training texts, of which only sentences of the holdout are kept
    both = _spoken(texts(spark, sf)).join(hold, "sentence", "left_semi").distinct().withColumn("status", F.lit("overlap"))
    return hold.join(both, "sentence", "left").select("sentence", F.coalesce("status", F.lit("holdout_only")).alias("status"))


@query("diversity_filter", f"""
WITH RECURSIVE edges0 AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {NEAR}),
o AS (SELECT vec_id AS id, row_number() OVER (ORDER BY md5('42|' || CAST(vec_id AS VARCHAR)), vec_id) AS r FROM embeddings),
edges AS (SELECT least(x.r, y.r) AS src, greatest(x.r, y.r) AS dst FROM edges0 e JOIN o x ON e.a = x.id JOIN o y ON e.b = y.id),
walk AS (
  SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS kept
  UNION ALL
  SELECT w.r + 1, CASE WHEN EXISTS (SELECT 1 FROM edges e WHERE e.dst = w.r + 1 AND list_contains(w.kept, e.src)) THEN w.kept ELSE list_append(w.kept, w.r + 1) END
  FROM walk w WHERE w.r < (SELECT max(r) FROM o))
SELECT o.id AS vec_id FROM o, (SELECT kept FROM walk ORDER BY r DESC LIMIT 1) k WHERE list_contains(k.kept, o.r)""")
def diversity_filter(spark, sf):
    # of equal vectors the earliest decides: the later ones are as close to it as can be, and to all that drops it
    reps = vecs(spark, sf).groupBy("vec").agg(F.min(F.struct(digest(F.col("id")).alias("place"), "id")).alias("first"))
    rows = reps.select("first.id", "vec")
    pairs = V.all_pairs(rows, NEAR)
    ha, hb = F.struct(digest(F.col("a")), F.col("a")), F.struct(digest(F.col("b")), F.col("b"))
    first = ha < hb
    edges = pairs.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("src"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("dst"))
    return rows.join(G.diversity_drops(edges), "id", "left_anti").select(F.col("id").alias("vec_id"))


@query("anchor_conflicts", f"""
WITH {SQL_CENTROIDS}
SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.vec, b.vec), 6) AS sim, list_cosine_similarity(a.vec, b.vec) > 0.2 AS conflict
FROM cents a JOIN cents b ON a.id < b.id WHERE list_cosine_similarity(a.vec, b.vec) >= 0.1""")
def anchor_conflicts(spark, sf):
    pairs = V.all_pairs(V.centroids(vecs(spark, sf), "label", "vec"), 0.1)
    return pairs.select("a", "b", F.round("sim", 6).alias("sim"), (F.col("sim") > 0.2).alias("conflict"))


# profiles = brands with their part names as terms; targets = the words of all part names and the nations
@query("profile_select", """
WITH profiles AS (
  SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS profile_id, list(DISTINCT p_name) AS terms,
         CAST(count(DISTINCT p_size) AS DOUBLE) / 100 + 0.1 * (count(*) % 7) AS base
  FROM part GROUP BY p_brand),
targets AS (SELECT DISTINCT lower(unnest(string_split(p_name, ' '))) AS target FROM part UNION SELECT lower(n_name) FROM nation),
scored AS (SELECT t.target, p.profile_id, p.base + 2 * len(list_filter(p.terms, lambda x: list_contains(string_split(x, ' '), t.target))) AS score FROM targets t, profiles p)
SELECT target, profile_id, round(score, 6) AS score, score < 0.5 AS low_confidence
FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY round(score, 9) DESC, profile_id) AS rn FROM scored) WHERE rn = 1""")
def profile_select(spark, sf):
    brand = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("long").alias("profile_id")
    part = table(spark, sf, "part")
    terms = part.select(brand, F.col("p_name").alias("term")).distinct()
    profiles = part.groupBy(brand).agg(F.countDistinct("p_size").alias("sizes"), F.count("*").alias("n")).select(
        "profile_id", (F.col("sizes") / 100).alias("pattern_count"), (F.col("n") % 7).alias("template_count"))
    targets = part.select(F.explode(F.split("p_name", " ")).alias("target")).unionByName(
        table(spark, sf, "nation").select(F.col("n_name").alias("target")))
    return J.profile_select(targets, profiles, terms=terms).withColumn("score", F.round("score", 6))
