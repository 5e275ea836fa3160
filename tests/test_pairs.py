"""Pair jobs on tables made for them: copies, repeated ids, large groups, and what they shuffle and write."""

import itertools
import os
import random
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomset.operators import listed, setblocks, setgroups
from loomset.operators import neardup as N
from loomset.operators import vectors as V
from loomset.plans import aggregating, load, views


def by_sql(name, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"create view {table} as select * from '{path}/*.parquet'")
    return con.execute(load().SQL[name]).fetchall()


def test_near_dup_pairs_lists_every_pair_of_rows(spark, tmp_path):
    # 1, 2 and 4 are copies, 3 is near to them; the second row of 2 is another vector; 7 and 8 have no length
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (4, [1.0, 0.0]), (3, [0.8, 0.6]), (2, [0.0, -1.0]), (5, [0.0, -1.0]), (7, [0.0, 0.0]), (8, [0.0, 0.0]), (9, None), (10, None)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(0)).write.parquet(path)
    got = Counter(tuple(r) for r in load().QUERIES["near_dup_pairs"](spark, str(tmp_path)).select("a", "b", "sim").collect())
    assert got == Counter({(1, 2, 1.0): 1, (1, 4, 1.0): 1, (2, 4, 1.0): 1, (1, 3, 0.8): 1, (2, 3, 0.8): 1, (3, 4, 0.8): 1, (2, 5, 1.0): 1, (7, 8, 1.0): 1})
    assert got == Counter(by_sql("near_dup_pairs", embeddings=path))


def test_rows_that_come_twice_pair_as_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.1])], "id long, vec array<float>")
    got = Counter((r.a, r.b) for r in V.near_dup_pairs(rows, "id", "vec", 0.9, every_copy=True).collect())
    assert got == {(1, 2): 2, (1, 3): 2, (2, 3): 1}


def brute_force(sets, threshold):
    """Pairs of rows (id, kind, items) with how often each comes."""
    out = Counter()
    for i, (a, _, x) in enumerate(sets):
        for b, _, y in sets[i + 1 :]:
            if a != b and len(set(x) & set(y)) / len(set(x) | set(y)) >= threshold:
                out[min(a, b), max(a, b)] += 1
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.9])
def test_groups_of_near_copies_equal_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(setgroups, "BLOCK_ROWS", 7)
    monkeypatch.setattr(setgroups, "_ROOM", 64)
    monkeypatch.setattr(listed, "_CHUNK_ITEMS", 300)
    rnd = random.Random(5)
    common = list(range(10**12, 10**12 + 3))
    sets = []
    for group in range(12):
        base = [rnd.getrandbits(60) for _ in range(40)]
        for _ in range(rnd.choice([1, 2, 3, 40])):
            fresh = [rnd.getrandbits(60) for _ in range(rnd.choice([0, 2, 8, 16]))]
            sets.append((len(sets), rnd.choice("ab"), base[len(fresh) :] + fresh + common))
    # ids that come again, with the same items and with others, and sets of one item
    sets += [sets[0], sets[3], (5, "a", sets[20][2]), (900, "b", [7]), (901, "a", [7]), (902, "a", [8])]
    frame = spark.createDataFrame(sets, "id long, kind string, items array<long>").repartition(5, "id")
    found = Counter((r.a, r.b) for r in N.jaccard_pairs(frame, threshold).collect())
    assert found == brute_force(sets, threshold)
    kinds = {(i, tuple(x)): k for i, k, x in sets}
    assert len(kinds) and {(r.a, r.b) for r in N.jaccard_pairs(frame.where("id <> 5"), threshold, other_than="kind").collect()} == {
        p for i, x in enumerate(sets) for y in sets[i + 1 :] if 5 not in (x[0], y[0]) and x[1] != y[1] for p in brute_force([x, y], threshold)}


def test_sets_that_share_too_little_are_not_dealt(spark):
    rnd = random.Random(6)
    sets = [(i, [rnd.getrandbits(60) for _ in range(300)]) for i in range(400)]
    sets = [(i, x[:290] + list(range(10))) for i, x in sets] + [(400, sets[0][1][5:290] + list(range(10)))]
    frame = spark.createDataFrame(sets, "id long, items array<long>")
    assert sorted(r.id for r in listed.may_pair(frame, 0.7).collect()) == [0, 400]
    found = N.jaccard_pairs(frame, 0.7)
    assert [(r.a, r.b) for r in found.collect()] == [(0, 400)]
    assert found.count() == 1
    # a tenth of the sets' bytes at most are written as sets
    written = [f for f in found.inputFiles() if "sets-" in f]
    assert written and sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in set(written)) < 400 * 300 * 8 / 10


def test_a_large_group_of_near_copies_is_not_met_by_item(spark):
    rnd = random.Random(7)
    base = [rnd.getrandbits(60) for _ in range(200)]
    sets = [(i, base[2:] + [rnd.getrandbits(60) for _ in range(2)]) for i in range(300)]
    frame = spark.createDataFrame(sets, "id long, items array<long>").select("id", "items", F.size("items").alias("n"), F.lit(None).cast("string").alias("kind"))
    frame = frame.withColumn("keys", setgroups.keys(F.col("items")))
    pairs = setgroups.pairs_in_groups(frame, 0.7, False, lambda ids: ids)
    found = [(r.a, r.b) for r in pairs.collect()]
    assert len(found) == len(set(found)) >= 0.999 * 300 * 299 / 2
    # the few that agree under no seed are found by their items
    assert sorted((r.a, r.b) for r in N.jaccard_pairs(frame, 0.7).collect()) == sorted(itertools.combinations(range(300), 2))


def test_shingles_of_texts_without_words_or_text(spark):
    rows = spark.createDataFrame([(1, ""), (2, "?!"), (3, None), (4, None), (5, "one two"), (6, "one two"), (7, "two one"), (8, "one two three")], "id long, t string")
    got = Counter((r.a, r.b) for r in N.near_dup_text_pairs(rows, "id", "t").collect())
    assert got == {(1, 2): 1, (3, 4): 1, (5, 6): 1}


@pytest.mark.parametrize("most, hot", [(4, 3), (2048, 512)])
def test_meetings_in_cells_equal_brute_force(spark, most, hot, monkeypatch):
    monkeypatch.setattr(setgroups, "MOST_ROWS", most)
    monkeypatch.setattr(setgroups, "keys", lambda items: F.array(*[F.col("id").cast("int")] * setgroups.SEEDS))
    monkeypatch.setattr(N, "keys", setgroups.keys)  # no groups: every pair is found by its items
    rnd = random.Random(8)
    sets = []
    for base in ([rnd.getrandbits(60) for _ in range(20)] for _ in range(6)):
        sets += [(len(sets) + i, "", rnd.sample(base, rnd.choice([12, 17, 20]))) for i in range(12)]
    frame = spark.createDataFrame(sets, "id long, kind string, items array<long>")
    found = Counter((r.a, r.b) for r in N.jaccard_pairs(frame, 0.6, hot).collect())
    assert found == brute_force(sets, 0.6) and len(found) > 50


def test_resolve_duplicates_sends_no_text_through_the_join_of_scores(spark, tmp_path, monkeypatch):
    text = ["a b c d e f g h i j", "a b c d e f g h i j", "a b c d e f g h i k", "other words", " ", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in enumerate(text, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    for name, df in (("documents", docs), ("labels", labels)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    joined = []
    look_up = views.with_scores
    monkeypatch.setattr(aggregating, "with_scores", lambda s, d, rows: (joined.append(rows.columns), look_up(s, d, rows))[1])
    got = {(r.id, r.reason) for r in load().QUERIES["resolve_duplicates"](spark, str(tmp_path)).collect()}
    # 7 of 9 shingles are shared by 1 and 3
    assert got == {(2, "exact_duplicate_of_1"), (3, "near_duplicate_of_1")}
    assert joined == [["doc_id", "digest"]]
    assert got == set(by_sql("resolve_duplicates", **{n: str(tmp_path / f"{n}.parquet") for n in ("documents", "labels")}))


@pytest.mark.parametrize("common, meetings, room", [(1, 5, 60), (16, 1 << 22, 1 << 20), (4096, 7, 300)])
def test_blocks_count_shared_items_exactly(spark, common, meetings, room, monkeypatch):
    for name, value in (("_COMMON", common), ("_MEETINGS", meetings), ("_ROOM", room)):
        monkeypatch.setattr(setblocks, name, value)
    rnd = random.Random(9)
    sets = [(i, rnd.choice("ab"), rnd.sample(range(60), rnd.choice([1, 4, 12, 30]))) for i in range(150)]
    frame = spark.createDataFrame([*sets, sets[7]], "id long, kind string, items array<long>")
    assert Counter((r.a, r.b) for r in N.jaccard_pairs(frame, 0.3).collect()) == brute_force([*sets, sets[7]], 0.3)
    # exact counts, not bounds: nothing is left to be decided on the items
    monkeypatch.setattr(setblocks, "_ROOM", 100)
    monkeypatch.setattr(setblocks.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    named = np.arange(common)
    packed = next(setblocks._pack(named)([pd.DataFrame({"id": [0, 1, 2], "kind": 0, "n": [3, 2, 1], "items": [[0, 5, 70], [5, 70], [9]]})]))
    batch = pa.RecordBatch.from_pandas(packed.add_prefix("l_"))
    block = setblocks._Sets(batch, 0, "l", common)
    assert setblocks._shared(block, block).tolist() == [[3, 2, 0], [2, 2, 0], [0, 0, 1]]
