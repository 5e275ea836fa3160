"""Columns of odd names and types, rows without an id, and benchmark items that share a window, for every operator."""

import hashlib
import random
import resource

import public_tokenizers as tokenizers_of
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomset.llm import (
    contamination, filter_audit, language_id, language_model, line_index, merges, near_text, near_vectors, quality, repair, repeats, token_files,
    trie_counts,
)

PIECES = tokenizers_of.path("piece_bpe_32k.model")


def texts(n=60, seed=1):
    make = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "ein", "und", "der", "Haus"]
    rows = [" ".join(make.choices(words, k=make.randint(5, 60))) for _ in range(n)]
    return rows + rows[:5] + ["x " * 40 + rows[0]]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents whose doc_id and some columns cannot be null, with names that need quotes."""
    rows = [(i, t, "en" if i % 2 else "de", "s", len(t)) for i, t in enumerate(texts())]
    plain = spark.createDataFrame(rows, "i long, text string, lang string, source string, n_chars long").repartition(3)
    made = plain.select(
        F.coalesce("i", F.lit(0)).alias("doc_id"), "text", "lang", "source", "n_chars", F.lit(1).alias("order"), F.lit("x").alias("my col"),
        F.lit(2).alias("a-b"), F.lit(3.5).alias("a.b"), F.lit("q").alias("tick`ed"), F.array(F.lit(1)).alias("list of"),
        F.struct(F.lit(1).alias("in side")).alias("row"), F.lit(None).cast("string").alias("c0"), F.lit(True).alias("g"),
    )
    assert not made.schema["doc_id"].nullable and not made.schema["order"].nullable
    return made


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    bench = [(1, " ".join(texts()[0].split()[:12])), (2, "words that stand nowhere else in all of this at all")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_of_any_name_and_type(spark, odd, sf, name, stage):
    out = stage(spark, odd, sf)
    rows = out.collect()
    assert rows
    if name != "pieces":
        assert out.columns == odd.columns
        given = {r.doc_id: r for r in odd.collect()}
        for r in rows:
            for place, column in enumerate(odd.columns):
                assert column in ("text", "n_chars") or r[place] == given[r.doc_id][place]


def test_operators_take_columns_of_any_name_and_type(spark, odd, sf):
    n = odd.count()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    labels = odd.select("doc_id", (F.col("doc_id") % 2).alias("quality"), F.lit(0).alias("toxic"), F.lit(1).alias("a b"))
    assert trie_counts.token_counts(odd, PIECES).count() == n
    assert contamination.contamination_report(odd, bench).count() == n
    assert near_text.near_duplicate_classes(odd, width=4).count() == n
    assert quality.quality_report(odd, labels).count() == n
    assert language_id.language_report(odd).count() == n
    assert token_files.token_file_report(odd, tokenizers_of.path("word_bpe_49k.json")).count() == n
    assert language_model.language_model_scores(odd, tokenizers_of.path("byte_bpe_50k.tiktoken"), tokenizers_of.PATTERN).count() == n
    found = repeats.repeated_passages(odd)
    assert found.select("row.doc_id", "row.`my col`", "row.`a.b`").count() == n
    assert merges.round_trip_report(odd, PIECES).count() == n
    assert filter_audit.filter_audit(odd, labels).count() == 1200
    assert line_index.line_dedup_report(odd).count() == n
    turns = odd.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text", "my col", "a-b", "`a.b`")
    assert repair.repaired(turns).count() == n


@pytest.mark.parametrize("kind, labels, equal", [
    ("string", ["a", "b", "a", None], True), ("double", [1.2, 1.7, 1.2, None], True), ("double", [0.0, 1.0, -0.0, None], True),
    ("boolean", [True, False, True, None], True), ("date", [None, None, None, None], False), ("binary", [b"\xff", b"\xfe", b"\xff", None], True),
    ("int", [1, 2, 1, None], True)])
def test_vector_labels_of_any_type(spark, kind, labels, equal):
    rows = [(i, label, [1.0, 0.0, 0.001 * i]) for i, label in enumerate(labels)]
    frame = spark.createDataFrame(rows, f"vec_id long, label {kind}, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vector_classes(frame).collect()}
    want = {i: (0, i) for i in range(4)} | ({0: (1, 0), 2: (1, 0)} if equal else {})
    assert got == want


def test_quality_labels_of_any_type_and_a_bounded_draw(spark):
    docs = spark.createDataFrame([(i, f"good words here {i}" if i % 2 else f"bad junk there {i}") for i in range(200)], "doc_id long, text string")
    marks = [(i, str(i % 2)) for i in range(200)] + [(3, "1.2"), (5, "high"), (7, None), (None, "1")] + [(11, "1")] * 500
    by_text = quality.train(docs, spark.createDataFrame(marks, "doc_id long, quality string"))
    by_number = quality.train(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int"))
    assert by_text.tolist() == by_number.tolist()
    hot = docs.unionByName(spark.range(3000).select(F.lit(4).cast("long").alias("doc_id"), F.lit("bad junk there 4").alias("text")))
    assert quality.train(hot, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")).tolist() == by_number.tolist()


def test_repeats_without_ids_meet_nobody(spark):
    rows = [(None, "the very same text that is long enough to be a passage of its own " * 3)] * 300 + [(1, "other " * 30), (2, "other " * 30)]
    got = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == 302
    for r in got:
        text = rows[0][1] if r.row.doc_id is None else rows[-1][1]
        assert r.n_bytes == len(text)
        if r.row.doc_id != 2:
            assert (r.n_removed, r.n_spans, r.kept_sha256, r.kept_text) == (0, 0, hashlib.sha256(text.encode()).hexdigest(), text)


def test_many_items_that_share_a_window(spark, monkeypatch):
    shared = "read the following text and then answer the question below it"
    bench = spark.createDataFrame([(i, f"{shared} item{i} a b c d e f g h i") for i in range(3000)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{shared} doc{i}" if i % 3 else f"clean text {i}") for i in range(900)], "doc_id long, text string")
    want = contamination.items_digest(list(range(3000)))
    got = contamination.contamination_report(docs, bench).collect()
    for r in got:
        assert (r.n_hit, r.n_items, r.contaminated, r.longest_match) == ((11, 3000, True, 11) if r.doc_id % 3 else (0, 0, False, 0))
        assert r.items_sha256 == (want if r.doc_id % 3 else contamination.items_digest([]))
    # the meetings of one slice are taken piece by piece
    test = contamination.TestSuffixes([(i, f"{shared} item{i}") for i in range(14_000)])
    import pyarrow as pa

    part = pa.RecordBatch.from_pydict({"text": [f"{shared} doc{i}" for i in range(400)]})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pieces = list(map(lambda p: (p.num_rows, len(p.column("matches").flatten())), contamination._search(test, [], True)([part])))
    assert sum(n for n, _ in pieces) == 400 and sum(m for _, m in pieces) == 400 * 14_000
    assert max(m for _, m in pieces) <= 2 * contamination.MEETINGS
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000
