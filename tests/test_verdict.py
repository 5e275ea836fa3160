"""Copies, open bounds and long chains, against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.functions import agreements as A
from loomset.functions import text as T
from loomset.operators import graphs as G
from loomset.operators import phrases as PH
from loomset.operators import stats as ST
from loomset.plans import evaluating, joining, load
from loomset.plans import aggregating
from loomset.operators.ranking import digest, exact_rank, range_bucket


def _vectors(spark, path, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/embeddings.parquet")


@pytest.fixture
def copies(spark, tmp_path):
    make = np.random.default_rng(3)
    base = make.standard_normal((12, 6))
    rows = [(i, [float(x) for x in base[make.integers(0, 12)]], int(make.integers(-1, 200))) for i in range(60)]
    _vectors(spark, tmp_path, rows)
    return str(tmp_path), rows


def test_diversity_filter_on_copies(spark, copies):
    path, rows = copies
    frame = spark.createDataFrame([(r[0],) for r in rows], "id long")
    order = [r.id for r in frame.orderBy(digest(F.col("id")), "id").collect()]
    unit = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in rows}
    kept = []
    for i in order:
        if all(unit[i] @ unit[k] < joining.NEAR for k in kept):
            kept.append(i)
    assert sorted(r.vec_id for r in joining.diversity_filter(spark, path).collect()) == sorted(kept)


def test_near_pairs_count_every_copy(spark, copies, tmp_path):
    path, rows = copies
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars").write.mode("overwrite").parquet(f"{path}/documents.parquet")
    unit = [np.array(r[1]) / np.linalg.norm(r[1]) for r in rows]
    pairs = [(i, j) for i in range(60) for j in range(i + 1, 60) if unit[i] @ unit[j] >= joining.NEAR]
    got = aggregating.dedup_stats(spark, path).first()
    assert (got.near_pairs, got.near_affected) == (len(pairs), len({x for p in pairs for x in p}))


def test_labels_out_of_bounds_are_counted(spark, copies):
    path, rows = copies
    got = {r.subset: r.n for r in evaluating.subset_accuracy_warnings(spark, path).collect()}
    assert got["comprehensive"] == sum(r[2] >= 6 for r in rows)


def test_long_chain_settles(spark):
    chain = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    dropped = {r.id for r in G.diversity_drops(chain.limit(40)).collect()}
    assert dropped == set(range(1, 41, 2))


def test_nfkc_by_default(spark):
    frame = spark.createDataFrame([("①ﬁＡ",), ("plain",), (None,)], "t string")
    assert [r.v for r in frame.select(T.clean_text(F.col("t")).alias("v")).collect()] == ["1fiA", "plain", ""]


def test_phrases_against_a_count(spark):
    texts = ["b a b a b a x", "", None, "Ab ab AB cd", "one two one two one two three", "a b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    want = set()
    for i, text in enumerate(texts):
        words = (text or "").lower().split()
        for size, top in ((2, 20), (3, 10)):
            grams = Counter(" ".join(words[k : k + size]) for k in range(len(words) - size + 1))
            order = sorted((-n, g) for g, n in grams.items() if n > 1)[:top]
            want |= {(i, size, g, -n, rank) for rank, (n, g) in enumerate(order, 1)}
    got = [(r.id, r.size, r.phrase, r.n, r["rank"]) for r in PH.key_phrases(frame, "id", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    words = spark.createDataFrame([(1, "stone Stone river stone river with with that"), (2, None)], "id long, text string")
    assert [(r.word, r.n, r["rank"]) for r in PH.keywords(words, "id", "text", stops=("with",)).collect()] == [("stone", 3, 1), ("river", 2, 2)]


def test_buckets_fill_evenly_for_spread_ids(spark):
    rows = spark.range(4000).select((F.col("id") * 1_000_003 * 4096).alias("id"))
    bucket = range_bucket(rows, "id", rows_each=500)
    sizes = [r["count"] for r in rows.groupBy(bucket.alias("b")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 700
    ranked = exact_rank(rows, ["id"], bucket).orderBy("id").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 4001))


def test_equal_deliverables_are_counted_in_one_pass(spark):
    items = [(1, "2 x Instagram Post"), (1, " 2 x instagram  post "), (1, "1 x TikTok Video"), (2, "1 x Blog Post")]
    low = spark.createDataFrame(items, "k long, item string").select("k", A.normal_item(F.col("item")).alias("d"), F.lower("item").alias("low"))
    flags = low.select("k", "d", *[c.alias(n) for n, c in A.item_flags(F.col("low")).items()])
    plain = flags.groupBy("k").agg(*[c.alias(n) for n, c in A.item_aggregates().items()])
    equal = flags.groupBy("k", "d").agg(*[c.alias(n) for n, c in A.equal_item_aggregates().items()])
    full = equal.groupBy("k").agg(*[c.alias(n) for n, c in A.distinct_item_aggregates("d").items()])
    assert sorted(map(tuple, full.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert [tuple(r) for r in full.orderBy("k").select("duplicates", "distinct_items", "first_duplicate").collect()] == [
        (1, 2, "2 x instagram post"), (0, 1, None)]


def test_flags_of_counted_deliverables_are_those_of_each(spark):
    items = [(1, "2 x Instagram  Post"), (1, " 2 x\tinstagram post "), (1, "Exclusive\nIGTV usage"), (2, None), (2, None), (2, "sto ries")]
    low = spark.createDataFrame(items, "k long, item string").select("k", A.normal_item(F.col("item")).alias("d"), F.lower("item").alias("low"))
    flags = low.select("k", "d", *[c.alias(n) for n, c in A.item_flags(F.col("low")).items()])
    each = flags.groupBy("k", "d").agg(*[c.alias(n) for n, c in A.equal_item_aggregates().items()])
    counted = low.groupBy("k", "d").agg(F.count("*").alias("items"))
    made = counted.select("k", "d", *[c.alias(n) for n, c in A.counted_item_flags(F.col("d"), F.col("items")).items()])
    assert made.dtypes == each.dtypes and sorted(map(str, made.collect())) == sorted(map(str, each.collect()))


def test_empty_bins_have_a_row(spark):
    rows = spark.createDataFrame([(0,), (1,), (10,)], "v long")
    got = {r.bin: (r.n, r.lowest) for r in ST.histogram(rows, "v", 5).collect()}
    assert got == {0: (2, 0), 1: (0, None), 2: (0, None), 3: (0, None), 4: (1, 10)}


def test_no_added_shuffle(spark):
    load()
    for name in ("clean_text", "stream_clean"):
        from loomset.plans.registry import QUERIES

        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" not in plan
