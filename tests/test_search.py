"""Negatives from other classes, joins and searches over cells, percentiles and dense numbers against brute force."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.operators import blocks as B
from loomset.operators import cells as C
from loomset.operators import joins as J
from loomset.operators import ranking as RK
from loomset.operators import stats as ST
from loomset.operators import vectors as V
from loomset.session import scratch_path
from loomset.sources import writers


def frame_of(spark, matrix, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id long, vec array<double>").repartition(4)


def clusters(n_clusters, each, dim=16, spread=0.02, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n_clusters, dim))
    return np.repeat(centres, each, axis=0) + spread * rng.standard_normal((n_clusters * each, dim))


def cosines(a, b=None):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    return unit(a) @ unit(a if b is None else b).T


# ---- negatives


def labelled(spark, sizes):
    rng, labels = np.random.default_rng(1), [c for c, n in enumerate(sizes) for _ in range(n)]
    rows = [(i, label, [float(x) for x in rng.standard_normal(8)]) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "id long, label long, vec array<double>").repartition(3), labels


def drawn_by_definition(labels, asking, count):
    """All rows outside the own class, in the seeded order that follows it, at evenly spread places."""
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    order = sorted(range(len(labels)), key=lambda i: (md5(f"42|{labels[i]}"), labels[i], md5(f"42|{i}"), i))
    out = set()
    for i in asking:
        own = [k for k, j in enumerate(order) if labels[j] == labels[i]]
        others = [order[(own[-1] + 1 + k) % len(order)] for k in range(len(order) - len(own))]
        drawn, step = int(md5(f"negative|{i}")[:15], 16), max(1, len(others) // count)
        out |= {(i, others[(drawn % len(others) + s * step) % len(others)], s) for s in range(min(count, len(others)))}
    return out


@pytest.mark.parametrize("sizes", [[60, 1, 7, 30, 2], [5, 5], [40, 1], [1, 1, 1]])
def test_rows_of_other_classes_equal_their_definition(spark, sizes):
    rows, labels = labelled(spark, sizes)
    ordered = J.class_order(rows, "id", "label")
    got = J.rows_of_other_classes(ordered, ordered, "id", "label", 4).collect()
    assert {(r.query, r.id, r.slot) for r in got} == drawn_by_definition(labels, range(len(labels)), 4)
    assert all(labels[r.query] == r.own and labels[r.id] == r.other != r.own for r in got)


def test_a_hot_class_beside_one_row(spark):
    rows, labels = labelled(spark, [300, 1, 50, 49])
    got = J.hard_negatives(rows, "id", "label", "vec", 3, 5).collect()
    per, reached = Counter(r["query"] for r in got), defaultdict(set)
    assert set(per.values()) == {3} and len(per) == 400
    for r in got:
        assert labels[r["query"]] != labels[r["id"]]
        reached[labels[r["query"]]].add(labels[r["id"]])
    assert reached[0] == {1, 2, 3} and reached[1] >= {0}
    first = {r["query"]: r["id"] for r in got if r["tier"] == 0}
    want = {(i, j) for i, j, s in drawn_by_definition(labels, range(400), 4) if s == 0}
    assert set(first.items()) == want


def test_negatives_where_there_are_too_few_and_none(spark):
    rows, labels = labelled(spark, [4, 1])
    got = Counter(r["query"] for r in J.hard_negatives(rows, "id", "label", "vec", 3, 2).collect())
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 3}
    alone, _ = labelled(spark, [6])
    assert J.hard_negatives(alone, "id", "label", "vec").count() == 0
    assert J.negative_pairs(alone, "id", "label").count() == 0
    nulls = rows.unionByName(rows.limit(2).select((F.col("id") + 100).alias("id"), F.lit(None).cast("long").alias("label"), "vec"))
    assert all(max(r["query"], r["id"]) < 100 for r in J.hard_negatives(nulls, "id", "label", "vec").collect())


def test_negative_pairs_reach_all_other_classes(spark):
    rows, labels = labelled(spark, [30] * 12)
    got = J.negative_pairs(rows, "id", "label", 10).collect()
    assert {(r.a, r.b) for r in got} == {(i, j) for i, j, _ in drawn_by_definition(labels, [30 * c + k for c in range(12) for k in range(10)], 1)}
    assert len({r.other for r in got if r.label == 0}) > 3


# ---- joins


@pytest.mark.parametrize("threshold, cell, block", [(0.9, 20, 7), (0.95, 10, 2048), (0.3, 16, 16), (0.0, 40, 16), (-0.5, 50, 32)])
def test_metric_join_equals_brute_force(spark, threshold, cell, block):
    data = np.vstack([clusters(12, 9, spread=0.2), clusters(3, 25, spread=0.01, seed=8)])
    sims = cosines(data)
    got = [(r.a, r.b) for r in C.metric_join(frame_of(spark, data), threshold, block, cell).collect()]
    want = {(i, j) for i, j in itertools.combinations(range(len(data)), 2) if sims[i, j] >= threshold}
    assert len(got) == len(set(got)) and set(got) == want


def test_cells_of_four_times_the_rows_cost_far_less_than_sixteen_times(spark):
    def products(n):
        data = clusters(n // 20, 20)
        rows = frame_of(spark, data)
        placed = C.joined_cells(rows, C.pivots(rows, 20), 0.95)
        sizes = placed.groupBy("cell").agg(F.count_if("home").alias("own"), F.count("*").alias("all"))
        return sizes.agg(F.sum(F.col("own") * F.col("all"))).first()[0]

    small, large = products(600), products(2400)
    assert large < 7 * small and large < 2400 * 2400 / 8


def test_pairs_of_every_copy(spark):
    rows = frame_of(spark, np.array([[1, 0], [1, 0], [1, 0], [0.99, 0.02], [0.99, 0.02], [0, 1.0]]))
    star = {(r.a, r.b) for r in V.near_dup_pairs(rows, "id", "vec", 0.9).collect()}
    assert star == {(0, 1), (0, 2), (0, 3), (3, 4)}
    every = [(r.a, r.b) for r in V.near_dup_pairs(rows, "id", "vec", 0.9, every_copy=True).collect()]
    assert sorted(every) == sorted(itertools.combinations(range(5), 2))


# ---- searches


def nearest(data, asked, k, exclude_self=False):
    sims = cosines(asked, data)
    out = {}
    for q, line in enumerate(sims):
        order = [i for i in np.lexsort((np.arange(len(line)), -line)) if not (exclude_self and i == q)]
        out[q] = order[:k]
    return out


def found(frame):
    out = defaultdict(dict)
    for r in frame.collect():
        out[r["query"]][r["rank"]] = r["id"]
    return {q: [ranks[i] for i in sorted(ranks)] for q, ranks in out.items()}


@pytest.mark.parametrize("most_beside", [4096, 30, 0])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_knn_by_every_way_equals_brute_force(spark, most_beside, exclude_self):
    data = np.vstack([clusters(15, 10, spread=0.1), np.random.default_rng(4).standard_normal((60, 16))])
    few, rows = frame_of(spark, data[:25]), frame_of(spark, data)
    for asked, queries in ((few, data[:25]), (rows, data)):
        got = found(V.knn(asked, rows, 6, exclude_self, most_beside))
        assert got == nearest(data, queries, 6, exclude_self)


@pytest.mark.parametrize("most_beside", [4096, 0])
def test_index_search_is_exact_and_reads_few_cells(spark, most_beside):
    data = clusters(40, 15, spread=0.01)
    index = C.VectorIndex.build(frame_of(spark, data), cell_rows=15)
    assert index.size.sum() == len(data) and len(index.size) == 40
    asked = data[::97] + 0.001
    assert found(index.search(frame_of(spark, asked), 5, False, most_beside)) == nearest(data, asked, 5)
    many = found(index.search(frame_of(spark, asked), 500, False, most_beside))
    assert many == nearest(data, asked, 500)
    unit = C.unit(asked)
    first = index.first_visits(index.bounds(unit), 5)
    kth = np.sort(cosines(asked, data), axis=1)[:, -5]
    needed = first | (index.bounds(unit) <= np.arccos(np.clip(kth, -1, 1))[:, None] + 1e-9)
    assert needed.sum(axis=1).mean() < 8


def test_few_queries_shuffle_no_corpus(spark):
    data = clusters(10, 20)
    rows = frame_of(spark, data[:50])
    big = spark.range(6000).select("id", F.array(*[F.sin(F.col("id") * k) for k in range(1, 17)]).alias("vec"))
    plan = V.knn(rows, big, 3)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("MapInPandas"):]
    assert "Exchange" not in scan and plan.count("MapInPandas") == 1
    ranking = V.full_ranking(big, rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in ranking


def test_searches_reject_bad_vectors(spark):
    rows = frame_of(spark, clusters(2, 4, dim=4))
    bad = lambda vec: spark.createDataFrame([(99, vec)], "id long, vec array<double>")
    for vec in ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0, float("nan")], [1.0, 2.0, 3.0, float("inf")], None, [1.0, 2.0, 3.0, None]):
        for asked, corpus, most in ((bad(vec), rows, 4096), (rows, rows.unionByName(bad(vec)), 4096), (rows, rows.unionByName(bad(vec)), 0), (rows.unionByName(bad(vec)), rows, 0)):
            with pytest.raises(Exception, match="finite|numbers"):
                V.knn(asked, corpus, 2, False, most).collect()
    for k in (0, -1):
        with pytest.raises(ValueError):
            V.knn(rows, rows, k)
    assert V.knn(rows.limit(0), rows, 2).count() == 0 and V.knn(rows, rows.limit(0), 2).count() == 0
    assert V.knn(rows.limit(0), rows, 2, False, 0).count() == 0


def test_equal_scores_go_by_id_at_the_cut(spark):
    rows = frame_of(spark, np.array([[1.0, 0.0]] * 7 + [[0.0, 1.0]] * 7))
    for most in (4096, 5, 0):
        got = found(V.knn(rows, rows, 3, False, most))
        assert got == {q: ([0, 1, 2] if q < 7 else [7, 8, 9]) for q in range(14)}


# ---- percentiles and numbers


@pytest.mark.parametrize("in_task", [1, 16, 1 << 17])
def test_percentiles_equal_numpy(spark, in_task):
    rng = np.random.default_rng(6)
    groups = {
        "normal": rng.standard_normal(4000), "one": np.array([3.5]), "two": np.array([1.0, 2.0]), "equal": np.full(900, 7.25),
        "mostly": np.concatenate([np.full(3000, 1.0), rng.random(900), np.full(2000, 0.5)]), "wide": np.exp(200 * rng.standard_normal(2500)),
        "steps": rng.integers(0, 5, 3000).astype(float), None: rng.random(700),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("empty", None), ("nan", float("nan")), ("one", None), ("one", float("nan"))]
    frame = spark.createDataFrame(rows, "g string, x double").repartition(4)
    points = {"p0": 0.0, "p5": 0.05, "median": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: [r[p] for p in points] for r in ST.exact_percentiles(frame, "x", points, ["g"], in_task).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == pytest.approx([np.quantile(values, p) for p in points.values()], rel=1e-12, abs=1e-300)
    whole = ST.exact_percentiles(frame, "x", {"median": 0.5}, (), in_task).first()["median"]
    assert whole == pytest.approx(np.median(np.concatenate(list(groups.values()))))
    assert ST.exact_percentiles(frame.limit(0), "x", points, ["g"]).count() == 0


def test_dense_numbers_of_any_ids(spark):
    rnd = random.Random(2)
    ids = [hashlib.md5(str(k).encode()).hexdigest() for k in range(900)] + ["same"] * 400 + [None] * 300
    rnd.shuffle(ids)
    rows = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    got = [(r.n, r.id) for r in RK.dense_numbers(rows, ["id"], "n").collect()]
    assert sorted(n for n, _ in got) == list(range(1, 1601))
    assert [i for _, i in sorted(got, key=lambda r: r[0])] == sorted(ids, key=lambda i: (i is not None, i or ""))
    numbers = [r.n for r in RK.dense_numbers(spark.range(-5, 5000, 7), ["id"], "n").orderBy("id").collect()]
    assert numbers == list(range(1, len(numbers) + 1))
    assert RK.dense_numbers(rows.limit(0), ["id"], "n").count() == 0


def test_batches_are_few_files_that_can_be_read_one_by_one(spark):
    rows = spark.createDataFrame([(hashlib.md5(str(k).encode()).hexdigest(), k) for k in range(2000)], "id string, k long")
    path = scratch_path(spark, "t-batches")
    writers.write_batches(writers.number_batches(rows, "id", 10), path)
    from pathlib import Path

    names = [p.name for p in Path(path.removeprefix("file:")).iterdir() if p.suffix == ".parquet"]
    assert len(names) <= spark.sparkContext.defaultParallelism * 2
    batch = writers.read_batch(spark, path, 7)
    want = sorted(hashlib.md5(str(k).encode()).hexdigest() for k in range(2000))[60:70]
    assert sorted(r.id for r in batch.collect()) == want
    assert "PushedFilters: [IsNotNull(batch_id), EqualTo(batch_id,7)]" in batch._jdf.queryExecution().toString()


# ---- blocks


@pytest.mark.parametrize("single", [True, False])
def test_blocks_equal_brute_force(spark, single):
    data = np.vstack([clusters(9, 30, spread=0.05), np.random.default_rng(5).standard_normal((150, 16)), np.zeros((2, 16))])
    data = data.astype(np.float32).astype(np.float64) if single else data
    rows = frame_of(spark, data)
    blocks = C.blocks_of_cells(rows, C.pivots(rows, 30), 16)
    assert blocks.where(F.col("single") == single).count() > 0 and blocks.agg(F.max(F.length("ids"))).first()[0] <= 16 * 8
    sims = cosines(data)
    got = [(r.a, r.b) for r in B.pairs(blocks, 0.4).collect()]
    assert len(got) == len(set(got)) and set(got) == {(i, j) for i, j in itertools.combinations(range(len(data)), 2) if sims[i, j] >= 0.4}
    assert found(C.top_k(B.nearest(blocks, blocks, 7, True), 7)) == nearest(data, data, 7, True)
    asked = C.blocks_of_cells(rows.where("id % 5 = 0"), C.pivots(rows, 30), 16)
    assert found(C.top_k(B.nearest(asked, blocks, 7), 7)) == {q: n for q, n in nearest(data, data, 7).items() if q % 5 == 0}


def test_searches_and_joins_shuffle_each_vector_once(spark):
    rng = np.random.default_rng(6)
    sent = {}
    for n in (300, 1200):
        rows = frame_of(spark, rng.standard_normal((n, 16)))
        centres = C.pivots(rows, 30)
        assert C.rows_sent(rows, centres, 0.4, 16) > C.MOST_SENT
        for name, frame in (("join", C.metric_join(rows, 0.4, 16, 30)), ("search", V.knn(rows, rows, 3, True, 0))):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            below = plan[plan.rindex("MapInArrow"):]
            assert "Exchange hash" not in below and "Exchange range" not in below, (name, below)
        sent[n] = C.rows_sent(rows, centres, 0.4, 16)
    assert sent[1200] > 2 * sent[300]


def test_waiting_blocks_hold_no_vectors(spark):
    import gc

    rows = frame_of(spark, np.random.default_rng(7).standard_normal((160, 6)))
    blocks = B.packed(rows.withColumn("cell", F.col("id") % 10).repartition(1).sortWithinPartitions("cell"), 16)
    left = B.crossed(blocks, blocks).toArrow()
    assert len(set(left.column("l_block").to_pylist())) >= 10
    held = []

    def coming():
        for batch in left.to_batches(max_chunksize=1):
            yield batch
            held.append(sum(isinstance(o, B._Block) for o in gc.get_objects()))

    found = list(B._searching(3, True, True)(coming()))
    assert sum(b.num_rows for b in found) == 3 * 160
    assert max(held) <= 3
