"""Ranks, splits, duplicates, graphs and similarity joins against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.operators import dedup as D
from loomset.operators import graphs as G
from loomset.operators import joins as J
from loomset.operators import neardup as N
from loomset.operators import ranking as RK
from loomset.operators import runs as RU
from loomset.operators import split as SP
from loomset.operators import stats as ST
from loomset.operators import vectors as V


def test_exact_rank_over_a_hot_key(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"))
    got = RK.exact_rank(rows, ["id"], F.shiftright("id", 5), ["k"]).collect()
    for key in ("hot", "cold"):
        ids = sorted((r["rank"], r["id"]) for r in got if r["k"] == key)
        assert [r for r, _ in ids] == list(range(1, len(ids) + 1))
        assert [i for _, i in ids] == sorted(i for _, i in ids)


def test_rolling_mean_across_blocks(spark):
    rnd = random.Random(1)
    values = [(i, i % 2, rnd.random()) for i in range(300)]
    rows = spark.createDataFrame(values, "i long, k long, v double")
    got = {r.i: r.recent_mean for r in ST.rolling_mean(rows, "k", ["i"], "v", F.shiftright("i", 4), 10, block_rows=20).collect()}
    for key in (0, 1):
        mine = [(i, v) for i, k, v in values if k == key]
        for place, (i, _) in enumerate(mine):
            want = 0.0 if place < 9 else sum(v for _, v in mine[place - 9:place + 1]) / 10
            assert got[i] == pytest.approx(want)
    assert len(got) == 300


def test_upper_median(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "fee double")
    assert ST.upper_median(rows, "fee", 1.5).first()[0] == 3.0


def test_pages(spark):
    rows = spark.range(250)
    page = RK.page(rows, [F.col("id")], 200, 100).collect()
    assert len(page) == 50 and page[0]["total"] == 250 and page[0]["next_offset"] is None
    assert RK.page(rows, [F.col("id")], 0, 100).first()["next_offset"] == 100


def test_missing_dates_sort_first(spark):
    rows = spark.createDataFrame([(1, "2024-01-02"), (2, None)], "id int, d string").select("id", F.to_timestamp("d").alias("finishedAt"))
    assert [r.id for r in RU.sort_runs(rows, "finishedAt:asc").collect()] == [2, 1]
    assert RU.sort_order(rows, "password:asc", RU.RUN_SORTS, "id") == []


def test_balance_counts_absent_classes(spark):
    rows = spark.createDataFrame([("c", "simple")] * 3, "facet string, value string")
    targets = spark.createDataFrame([("c", "simple", 0.5), ("c", "medium", 0.3), ("c", "complex", 0.2)], "facet string, value string, target double")
    assert ST.balance_scores(rows, targets).first()["balance"] == pytest.approx((0.5 + 0.7 + 0.8) / 3)


def test_mrr(spark):
    ranks = spark.createDataFrame([(1,), (2,), (4,)], "rank long")
    got = V.recall_and_mrr(ranks).first()
    assert got["mrr"] == pytest.approx(0.583333, abs=1e-6) and got["recall_at_1"] == pytest.approx(1 / 3)


def test_group_split_equals_the_loop(spark):
    rnd = random.Random(3)
    rows = [(f"g{g}", f"s{rnd.randrange(3)}") for g in range(60) for _ in range(rnd.randrange(1, 9))]
    frame = spark.createDataFrame(rows, "grp string, stratum string")
    got = {r.grp: (r.stratum, r.size, r.split) for r in SP.group_stratified_split(frame, "grp", "stratum").collect()}
    by_stratum: dict = {}
    for g, (s, size, _) in got.items():
        by_stratum.setdefault(s, []).append((hashlib.md5(f"42|{g}".encode()).hexdigest(), g, size))
    for groups in by_stratum.values():
        total = sum(size for *_, size in groups)
        train, val, in_train, in_val = int(total * 0.7), int(total * 0.15), 0, 0
        for _, g, size in sorted(groups):
            if in_train < train:
                want, in_train = "train", in_train + size
            elif in_val < val:
                want, in_val = "val", in_val + size
            else:
                want = "test"
            assert got[g][2] == want


@pytest.mark.parametrize("n, want", [(1, (1, 0, 0)), (2, (1, 1, 0)), (3, (1, 1, 1)), (10, (7, 1, 2)), (20, (14, 3, 3))])
def test_small_groups(spark, n, want):
    rows = spark.range(n).withColumn("s", F.lit("x"))
    got = [r.split for r in SP.small_group_split(rows, "id", "s").collect()]
    assert tuple(got.count(s) for s in SP.SPLITS) == want


def test_single_document_profile_goes_to_test(spark):
    rows = spark.range(1).withColumn("s", F.lit("x"))
    assert SP.profile_stratified_split(rows, "id", "s").first()["split"] == "test"


def test_leaks_are_found(spark):
    rows = spark.createDataFrame([("a", "train"), ("a", "val"), ("b", "test")], "g string, split string")
    assert [r.g for r in SP.split_leaks(rows, "g").collect()] == ["a"]
    with pytest.raises(ValueError):
        SP.require_no_leaks(rows, "g")


def test_batches_hold_a_group_once(spark):
    rows = spark.range(100).withColumn("g", F.col("id") % 30)
    got = SP.group_unique_batches(rows, "id", "g", 7).collect()
    assert len(got) == 30
    for batch in {r.batch for r in got}:
        keys = [r.group_key for r in got if r.batch == batch]
        assert len(keys) == len(set(keys)) <= 7


def test_resolve_duplicates(spark):
    rows = spark.createDataFrame([("a", "t", 0.9, False), ("b", "t", 0.9, False), ("c", "t", 0.5, False)], "id string, text string, coherence double, is_ood boolean")
    none = spark.createDataFrame([], "a string, b string")
    got = {r.id: r.reason for r in D.resolve_duplicates(rows, none).collect()}
    assert got == {"a": "exact_duplicate_of_b", "c": "exact_duplicate_of_b"}
    left = rows.join(spark.createDataFrame([(k,) for k in got], "id string"), "id", "left_anti")
    assert D.resolve_duplicates(left, none).count() == 0


def test_string_order_of_ids(spark):
    rows = spark.createDataFrame([(9, "t", 1.0, False), (10, "t", 1.0, False)], "id long, text string, coherence double, is_ood boolean")
    got = D.resolve_duplicates(rows, spark.createDataFrame([], "a long, b long")).first()
    assert (got.id, got.reason) == (10, "exact_duplicate_of_9")


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    got = {r.id: r.component for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}


@pytest.mark.parametrize("seed", [1, 2])
def test_diversity_equals_the_sequence(spark, seed):
    rnd = random.Random(seed)
    edges = sorted({tuple(sorted(rnd.sample(range(60), 2))) for _ in range(120)})
    kept: set = set()
    for i in range(60):
        if not any((j, i) in edges for j in kept):
            kept.add(i)
    frame = spark.createDataFrame(edges, "src long, dst long")
    assert {r.id for r in G.diversity_drops(frame).collect()} == set(range(60)) - kept
    assert G.diversity_drops(frame.limit(0)).count() == 0


def _vectors(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id long, vec array<float>")


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 16))
    near = base[:50] + 0.05 * rng.standard_normal((50, 16))
    return np.float32(np.vstack([base, near]))


def _cosines(matrix):
    unit = matrix.astype(float) / np.linalg.norm(matrix.astype(float), axis=1, keepdims=True)
    return unit @ unit.T


@pytest.mark.parametrize("block", [16, 2048])
def test_pairs_equal_brute_force_whatever_the_block(spark, planted, block):
    rows = _vectors(spark, planted)
    sims = _cosines(planted)
    want = {(i, j) for i in range(len(sims)) for j in range(i + 1, len(sims)) if sims[i, j] >= 0.9}
    # a third of the rows share one bucket, every row has a bucket of its own besides
    buckets = rows.withColumn("bucket", F.explode(F.array(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10), F.lit(0))))
    for found in (V.all_pairs(rows, 0.9, block), V.pairs_in_buckets(buckets, 0.9, block)):
        got = {(r.a, r.b): r.sim for r in found.collect()}
        assert set(got) == want and all(got[p] == pytest.approx(sims[p]) for p in want)


def test_copies_are_linked_to_the_first(spark):
    rows = _vectors(spark, np.float32([[1, 0], [1, 0], [1, 0], [0, 1]]))
    got = {(r.a, r.b) for r in V.near_dup_pairs(rows, "id", "vec", 0.95).collect()}
    assert got == {(0, 1), (0, 2)}


def test_bands_are_right_and_find_most(spark, planted):
    rows = _vectors(spark, planted)
    exact = {(r.a, r.b) for r in V.near_dup_pairs(rows, "id", "vec", 0.95).collect()}
    banded = {(r.a, r.b) for r in V.near_dup_pairs_banded(rows, "id", "vec", 16, 0.95, 24, 10).collect()}
    assert banded <= exact and len(banded) >= 0.97 * len(exact)


@pytest.mark.parametrize("block", [16, 2048])
def test_knn_equals_brute_force(spark, planted, block):
    rows = _vectors(spark, planted)
    found = V.scores_in_cells(rows, rows, 5, True, block)
    got = RK.top_n_per_group(found, ["query"], [F.col("sim").desc(), F.col("id")], 5).collect()
    sims = _cosines(planted)
    np.fill_diagonal(sims, -9)
    for i in range(0, 200, 17):
        want = list(np.argsort(-sims[i], kind="stable")[:5])
        assert [r.id for r in sorted((r for r in got if r["query"] == i), key=lambda r: r["rank"])] == want
    with pytest.raises(ValueError):
        V.knn(rows, rows, 0)


@pytest.mark.parametrize("threshold, hot", [(0.3, 2), (0.5, 4096), (0.8, 3)])
def test_jaccard_equals_brute_force(spark, threshold, hot):
    rnd = random.Random(11)
    sets = []
    for i in range(120):
        # item 0 is in two of three sets and a third of the sets are near copies
        items = set(range(100, 130)) - set(rnd.sample(range(100, 130), 3)) if i % 3 == 0 else {rnd.randrange(60) for _ in range(rnd.randrange(1, 25))}
        sets.append((i, sorted(items | ({0} if i % 3 else set()))))
    frame = spark.createDataFrame(sets, "id long, items array<long>")
    got = {(r.a, r.b): r.jaccard for r in N.jaccard_pairs(frame, threshold, hot).collect()}
    want = {}
    for (i, x), (j, y) in itertools.combinations(sets, 2):
        score = len(set(x) & set(y)) / len(set(x) | set(y))
        if score >= threshold:
            want[i, j] = score
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)


def test_text_copies_make_a_star(spark):
    text = "one two three four five"
    rows = spark.createDataFrame([(1, text), (2, text), (3, text), (4, "other words here now")], "id long, t string")
    assert {(r.a, r.b) for r in N.near_dup_text_pairs(rows, "id", "t").collect()} == {(1, 2), (1, 3)}


def test_negatives_are_of_another_class(spark, planted):
    rows = _vectors(spark, planted).withColumn("label", F.col("id") % 4)
    got = J.hard_negatives(rows, "id", "label", "vec", 3, 10).collect()
    assert len(got) == 600 and all(r["query"] % 4 != r["id"] % 4 for r in got)


def test_profile_ties_and_fallback(spark):
    profiles = spark.createDataFrame([(1, ["red fox"], 0.2, 1), (2, ["blue fox", "fox"], 0.0, 0), (3, ["cow"], 0.4, 0)], "profile_id long, terms array<string>, pattern_count double, template_count int")
    targets = spark.createDataFrame([("fox",), ("zebra",)], "target string")
    got = {r.target: (r.profile_id, round(r.score, 6), r.low_confidence) for r in J.profile_select(targets, profiles).collect()}
    assert got == {"fox": (2, 4.0, False), "zebra": (3, 0.4, True)}


@pytest.mark.parametrize("threshold", [0.1, 0.3])
def test_low_jaccard_by_blocks_equals_brute_force(spark, threshold):
    rnd = random.Random(4)
    sets = {i: set(rnd.sample(range(60 if i % 3 else 400), rnd.choice([1, 5, 20, 50]))) for i in range(300)}
    kinds = {i: rnd.choice(["a", "b", None]) for i in sets}
    rows = spark.createDataFrame([(i, kinds[i], [(x * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63) for x in s]) for i, s in sets.items()], "id long, kind string, items array<long>")
    want = {(a, b): len(x & y) / len(x | y) for a, x in sets.items() for b, y in sets.items() if a < b}
    want = {p: j for p, j in want.items() if j >= threshold}
    found = N.jaccard_pairs(rows, threshold)
    assert {(r.a, r.b): r.jaccard for r in found.collect()} == want and found.count() == len(want)
    apart = {(r.a, r.b) for r in N.jaccard_pairs(rows, threshold, other_than="kind").collect()}
    assert apart == {(a, b) for a, b in want if kinds[a] and kinds[b] and kinds[a] != kinds[b]}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan  # items are not joined one by one


def test_items_of_sets_are_shuffled_once(spark):
    frame = spark.range(40).select("id", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda x: F.xxhash64(x * F.col("id"))).alias("items"))
    found = N.jaccard_pairs(frame, 0.8)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(item" in line and "REPARTITION" not in line]
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(item" in line and "REPARTITION" in line and "Reused" not in line]
    assert dealt and len({line[line.index("plan_id"):] for line in dealt}) == 1
