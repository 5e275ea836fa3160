"""The ten operators and the pipeline against brute force, libraries and held-out figures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as tokenizers_of
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

import __spark_entry__ as entry
import corpus_pipeline
from loomset.llm import (
    attention, contamination, flat, language_id, language_model, merges, near_text, near_vectors, pieces, quality, repeats,
    token_files, trie_counts,
)
from loomset.llm.links import classes

SF = "/root/testdata/sf0.001"
PIECES, WORDS = tokenizers_of.path("piece_bpe_32k.model"), tokenizers_of.path("word_bpe_49k.json")
RANKS = tokenizers_of.path("byte_bpe_50k.tiktoken")
KIND = "doc_id long, text string, lang string, source string, n_chars long, g int, id long, `row` string"


def odd_texts():
    make = random.Random(5)
    words = [make.choice("abcdeé") * make.randint(1, 4) + make.choice(["", "x", "1", "."]) for _ in range(60)]
    text = lambda n: " ".join(make.choice(words) for _ in range(n))
    shared, long = text(30), text(4000)
    near = shared.split()
    rows = [None, "", "   \n\t", "?!", "one", "One two", "日本語 テキスト 😀", "a" * 3000, long, long, long[:-9] + " zz", shared, shared]
    rows += [" ".join(near[:29] + [f"w{k}"]) for k in range(12)]
    rows += [text(12) + " " + shared + " " + text(9) for _ in range(6)] + [text(make.randint(1, 90)) for _ in range(25)]
    rows += ["x y z", "x y z", "▁ a  b ▁", "it's <|endoftext|> x<|startoftext|>", "<s> </s> <0x41> \x00 \u00a0 é e\u0301"]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts with nulls in every column, repeated rows and further columns of names used inside."""
    rows = [(i * 3, t, None if i % 5 == 0 else "en", None, None, i, None, "r") for i, t in enumerate(odd_texts())]
    rows += [(None, "no id here at all but some words", "en", "s", 1, 0, 0, None), rows[9], rows[20]]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def unique(spark):
    return spark.createDataFrame([(i * 3, t) for i, t in enumerate(odd_texts())], "doc_id long, text string").repartition(3)


def collected(frame, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in frame.collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return [w for w in re.split("[\\x20\\x09-\\x0d]+", lower(text)) if w]


# ---- helpers


def test_flat_words_and_hashes():
    column = pa.array([t or "" for t in odd_texts()])
    texts = flat.lowered(flat.texts_of(column))
    found = flat.words_of(texts, flat.NOT_SPACE)
    value = flat.word_hashes(texts, found)
    seen = {}
    for a, b, h in zip(found.start, found.end, value):
        assert seen.setdefault(texts.data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)
    assert np.diff(found.first).tolist() == [len(plain_words(t)) for t in odd_texts()]


def test_classes_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.id: r.component for r in classes(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert classes(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1 token counts


def test_trie_counts_equal_exhaustive_search():
    table = trie_counts.PieceScores(pieces.read_pieces(PIECES))
    make = random.Random(1)
    words = [" " + "".join(make.choice("theraonsié日\U0001F600~") for _ in range(make.randint(1, 6))) for _ in range(200)] + [" " + "tion" * 30]

    def best(text):
        chars = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = []
            for at in range(end - 1, -1, -1):
                score = table.spelled.get(text[at:end].encode())
                if score is not None:
                    options.append((chars[0][at] + score, end - at, chars[1][at] + 1))
                elif end - at == 1:
                    options.append((chars[0][at] + table.unknown, 1, chars[1][at] + len(text[at:end].encode())))
            score, _, n = max(options, key=lambda o: (o[0], o[1]))
            chars[0].append(score)
            chars[1].append(n)
        return chars[1][-1]

    column = flat.texts_of(pa.array(words))
    assert table.count(column).tolist() == [best(w) for w in words]


def test_token_counts_of_odd_rows(spark, docs):
    got = trie_counts.token_counts(docs, PIECES)
    assert got.count() == docs.count()
    rows = {r.doc_id: r for r in got.where("doc_id <= 3").collect()}
    assert rows[0].n_tokens == 0 and rows[3].n_tokens == 0
    assert trie_counts.token_counts(docs.limit(0), PIECES).count() == 0


# ---- 2 decontamination


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_contamination_by_brute_force(spark, docs, unique, block_bytes):
    texts = [t for t in odd_texts() if t]
    items = [(1, " ".join(texts[11].split()[4:22])), (2, "x Y  z"), (10, None), (11, "  "), (3, texts[30]), (4, "ONE"), (5, texts[11])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lower(t))
    windows = {}
    for item, text in items:
        w = split(text)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    got = collected(
        contamination.contamination_report(unique, benchmark, block_bytes=block_bytes), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    for i, text in enumerate(odd_texts()):
        w, hit, found = split(text), set(), set()
        for key, of in windows.items():
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k : k + len(key)]) == key:
                    hit |= set(range(k, k + len(key)))
                    found |= of
        assert got[i * 3] == (len(w), len(hit), len(found), contamination.items_digest(found), bool(hit))
    clean = contamination.without_contaminated(docs, benchmark, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    bad = {k for k, v in got.items() if v[-1]}
    assert sorted(r.doc_id for r in clean.where("doc_id IS NOT NULL").collect()) == sorted(
        r.doc_id for r in docs.where("doc_id IS NOT NULL").collect() if r.doc_id not in bad)
    assert contamination.contamination_report(docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert contamination.contamination_report(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_items_without_an_id_are_searched(spark, block_bytes):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, "so " + text + " it is"), (2, "clean words"), (3, "x y z and short")], "doc_id long, text string")
    items = [(None, text), (None, "y z"), (7, "x y"), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = collected(contamination.contamination_report(docs, bench, block_bytes=block_bytes), "n_hit", "n_items", "items_sha256", "contaminated", "longest_match")
    none = contamination.items_digest([])
    assert got == {1: (11, 0, none, True, 11), 2: (0, 0, none, False, 0), 3: (3, 1, contamination.items_digest([7]), True, 2)}
    assert [r.doc_id for r in contamination.without_contaminated(docs, bench, block_bytes=block_bytes).collect()] == [2]


def test_longest_match_and_place(spark):
    words = [f"w{i}" for i in range(40)]
    frame = spark.createDataFrame([(1, "a b " + " ".join(words[5:30]) + " c")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    match = contamination.benchmark_matches(frame, bench).first().matches
    assert [(m.item_id, m.doc_word, m.item_word, m.n_words) for m in match] == [(7, 2, 5, 25)]


# ---- 3 vectors


def test_vectors_by_brute_force(spark):
    make = np.random.default_rng(2)
    centre = make.standard_normal((30, 16))
    data = np.concatenate([centre + make.standard_normal((30, 16)) * s for s in (0, 0.1, 0.2, 0.25, 0.3)])
    rows = [(i, [float(x) for x in v], int(i % 3 == 0)) for i, v in enumerate(data)] + [(500, [float(x) for x in data[0]], 1)]
    bad = [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, [1.0, None], 1), (905, rows[0][1], None),
           (906, [float("inf")] * 16, 1), (907, [3.0], 1), (908, [9.0], 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vector_classes(frame, cell_rows=16).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows + bad[7:]}
    label = {i: k for i, _, k in rows + bad[7:]}
    links = {i: {j for j in unit if j != i and label[i] == label[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93} for i in unit}
    for i in unit:
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        assert got[i] == (len(links[i]), min(reach), min(reach) == i)
    assert all(got[i] == (0, i, True) for i in range(900, 907))
    assert near_vectors.near_vector_classes(frame.limit(0)).count() == 0


def test_filters_find_pairs_at_the_threshold():
    make = np.random.default_rng(4)
    x = make.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = make.standard_normal((400, 64))
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * side
    filters = near_vectors.Filters(64, 128, near_vectors.LISTS)
    sets = [[{(int(f), int(s)) for f, seconds in zip(*row) for s in seconds} for row in filters.decode(z)] for z in (x, y)]
    assert np.mean([bool(a & b) for a, b in zip(*sets)]) > 0.99


# ---- 4 documents


def text_links(texts, width, threshold=80):
    sets = {}
    for i, t in texts.items():
        w = plain_words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    near = {i: {j for j in sets if i != j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])} for i in sets}
    lowest = {}
    for i in sets:
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        lowest[i] = min(reach)
    return sets, lowest


@pytest.mark.parametrize("hubs", [1, 256])
def test_near_documents_by_brute_force(spark, unique, hubs):
    texts = dict((r.doc_id, r.text) for r in unique.collect())
    sets, lowest = text_links(texts, 4)
    got = collected(near_text.near_duplicate_classes(unique, width=4, hubs=hubs), "n_shingles", "component_id", "kept")
    assert got == {i: (len(sets[i]), lowest[i], lowest[i] == i) for i in texts}


def test_near_documents_odd_rows(spark, docs):
    got = near_text.near_duplicate_classes(docs)
    assert got.count() == docs.count() and got.where("doc_id IS NULL AND kept").count() == 1
    kept = near_text.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert near_text.near_duplicate_classes(docs.limit(0)).count() == 0


def test_circulant_signatures_estimate_similarity():
    make = np.random.default_rng(0)
    a, b = (make.integers(0, 2**63, 500).astype(np.uint64) for _ in range(2))
    b[:400] = a[:400]
    signed = near_text.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, 500, 1000]), 512)
    assert abs((signed[0] == signed[1]).mean() - 400 / 600) < 0.08


# ---- 5 and 6


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = entry.queries()["op5_quality"](spark, sf).join(labels, "doc_id").where("held_out AND quality IS NOT NULL")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.9


def test_quality_odd_rows(spark, docs):
    labels = spark.createDataFrame([(12, 1), (15, 0), (None, 1), (24, None), (99999, 0)], "doc_id long, quality int")
    got = quality.quality_report(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r.score for r in quality.quality_report(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_report(docs.limit(0), labels).count() == 0


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op6_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98


def test_language_costs_by_definition():
    rows = [("a", "the cat the hat"), ("b", "der hut der hund")]
    table = pa.Table.from_batches(list(language_id._count(4)(iter([pa.RecordBatch.from_pylist([{"lang": l, "text": t} for l, t in rows])]))))
    trees = language_id.Trees(table, 4)
    counts = {l: Counter() for l in "ab"}
    for lang, text in rows:
        for w in text.split():
            s = f" {w} "
            for i in range(1, len(s)):
                for k in range(min(i, 4) + 1):
                    counts[lang][s[i - k : i], s[i]] += 1

    def bits(lang, context, byte):
        own = {s: n for (c, s), n in counts[lang].items() if c == context}
        total = sum(own.values()) + len(own)
        if byte in own:
            return -math.log2(own[byte] / total)
        shorter = 8.0 if not context else bits(lang, context[1:], byte)
        return shorter + (-math.log2(len(own) / total) if own else 0)

    words, number, _ = language_id._distinct_words(pa.array(["the hund xyz"]))
    got = trees.word_bits(words)[number]
    for row, w in zip(got, ["the", "hund", "xyz"]):
        s = f" {w} "
        for k, lang in enumerate("ab"):
            want = sum(bits(lang, s[max(0, i - 4) : i], s[i]) for i in range(1, len(s)))
            assert row[k] == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("with_id", [True, False])
def test_language_of_few_texts_with_many_copies_is_learned(spark, with_id):
    """Each language of two texts with copies is predicted, however small its share of the sample is."""
    rows, alphabets = [], ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "αβγδε", "абвгд", "אבגדה"]
    make = random.Random(3)
    for alphabet in alphabets:
        texts = [" ".join("".join(make.choices(alphabet, k=5)) for _ in range(50)) for _ in range(2)]
        rows += [(len(rows) + k if with_id else None, texts[k % 2], alphabet) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for sample_bytes in (1, 600):
        trees = language_id.fit_trees(frame, sample_bytes=sample_bytes)
        assert trees.langs == sorted(alphabets)
        kept = [StructField("lang", StringType())]
        assert language_id.predict(frame, kept, trees).where("lang != lang_pred").count() == 0


def test_model_sample_is_bounded_and_drawn_by_document(spark):
    """Copies of one text are drawn one by one, and the bytes that reach the driver are bounded."""
    for ids in (True, False):
        for text in (f"hot text {k} " * 8 for k in range(4)):
            rows = [(i if ids or i % 3 else None, text if i % 3 == 0 else f"text {i} " * 8) for i in range(3000)]
            frame = spark.createDataFrame(rows, "doc_id long, text string")
            size = sum(len(t) for _, t in rows)
            got = language_model.training_sample(frame, 20000, size)
            assert 5000 < sum(map(len, got)) <= 40000
            assert (got.count(text) > 20) if ids else (got.count(text) <= 1)
    assert language_model.training_sample(frame.limit(0), 20000, 0) == []


def test_language_odd_rows(spark, docs):
    got = language_id.language_report(docs)
    assert got.count() == docs.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (0, 3, 6, 9))
    assert {r.lang_pred for r in language_id.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_id.with_known_language(docs).columns == docs.columns
    assert language_id.language_report(docs.limit(0)).count() == 0


# ---- 7 token files


def test_token_files_equal_the_library(spark, unique):
    from tokenizers import Tokenizer

    library, at = Tokenizer.from_file(WORDS), 0
    got = collected(token_files.token_file_report(unique, WORDS, length=32), "start", "n_tokens", "ids_crc32")
    for i, text in enumerate(odd_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i * 3] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        at += len(ids)


def test_token_files_rows_and_masks(spark, docs):
    found = token_files.write_token_files(docs, WORDS, length=32).collect()
    assert len(found) == docs.count()
    for path in {r.path for r in found}:
        file = token_files.TokenFile(path)
        total = sum(r.n_tokens for r in found if r.path == path)
        masks = [file.sequence(k) for k in range(-(-total // 32))]
        assert sum(int(m.sum()) for _, m in masks) == total and all(len(i) == 32 for i, _ in masks)
    assert token_files.token_file_report(docs.limit(0), WORDS).count() == 0


# ---- 8 language model


def test_attention_gradients_and_blocks():
    make = np.random.default_rng(1)
    model = attention.Model(30)
    model.weights = {k: make.standard_normal(v.shape) * 0.3 for k, v in model.weights.items()}
    inputs, first = make.integers(0, 31, (3, 32)), np.array([True, False, False])
    targets, real = make.integers(0, attention.CLASSES, (3, 16)), make.random((3, 16)) < 0.8
    _, found = model.gradients(inputs, first, targets, real)
    for name in ("query", "key", "value", "bias", "mix", "skip", "out", "out_bias", "inner", "inner", "inner_bias"):
        at = tuple(make.integers(0, s) for s in model.weights[name].shape)
        old, losses = model.weights[name][at], []
        for step in (1e-5, -1e-5):
            model.weights[name][at] = old + step
            losses.append(model.gradients(inputs, first, targets, real)[0])
        model.weights[name][at] = old
        assert found[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-5, rel=1e-3)


def test_attention_steps_follow_the_plain_rule():
    """Changes of a token's rows are summed over its places; a step without the loss has the same gradients and moves as Adam does."""
    make = np.random.default_rng(3)
    model = attention.Model(30)
    model.weights = {k: make.standard_normal(v.shape) * 0.3 for k, v in model.weights.items()}
    inputs, first = make.integers(0, 31, (3, 32)), np.array([True, False, False])
    targets, real = make.integers(0, attention.CLASSES, (3, 16)), make.random((3, 16)) < 0.8
    _, found = model.gradients(inputs, first, targets, real, False)
    total = np.zeros_like(model.weights["embed"])
    np.add.at(total, found["embed"][0], found["embed"][1])
    for at in [(int(t), int(k)) for t, k in zip(inputs[:, 20], (0, 7, 15))]:
        old, losses = model.weights["embed"][at], []
        for step in (1e-5, -1e-5):
            model.weights["embed"][at] = old + step
            losses.append(model.gradients(inputs, first, targets, real)[0])
        model.weights["embed"][at] = old
        assert total[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-5, rel=1e-3)
    mean, square, change = np.array([0.5, 0.0]), np.array([0.25, 0.0]), np.array([1.0, 0.0])
    assert attention._moved(change, mean, square, 0.1) == pytest.approx([0.1 * 0.55 / (np.sqrt(0.2575) + 1e-8), 0])
    assert mean == pytest.approx([0.55, 0]) and square == pytest.approx([0.2575, 0])


def test_attention_is_causal_and_scores_do_not_depend_on_batching():
    make = np.random.default_rng(1)
    ids, first = make.integers(0, 30, 90), np.array([0, 50, 50, 90])
    words = attention.Vocabulary(ids, np.append(30, ids)[:-1], make.random(30) < 0.5)
    model = attention.train(ids, first, words, steps=5)
    whole = attention.token_scores(model, words, ids, first)[0]
    assert np.allclose(whole, attention.token_scores(model, words, ids, first, at_once=1)[0], atol=1e-4)
    changed = ids.copy()
    changed[30:50] = 0
    assert np.allclose(whole[:30], attention.token_scores(model, words, changed, first)[0][:30], atol=1e-4)
    before = make.integers(0, 31, 4)
    for b in before:  # shares of all tokens of a class after a token add up to one
        share = np.exp(words.shares(np.full(30, b), np.arange(30)))
        assert np.bincount(words.klass, share)[np.unique(words.klass)] == pytest.approx(1, rel=1e-5)


def test_base_scores_by_brute_force(spark, docs):
    got = language_model.language_model_scores(docs, RANKS, tokenizers_of.PATTERN, steps=5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in [*plain_words(t), ""])
    n, v = sum(counts.values()), len(counts)
    for r in got.collect():
        text = next(t for i, t in rows if i == r.doc_id)
        tokens = [*plain_words(text), ""]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens), n)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        assert r.score <= 0 and math.isfinite(r.score)
    assert got.count() == docs.count()


def test_token_pairs_of_all_training_documents_count(spark):
    """The sample is empty here, so only counts over all documents can tell the order of two words."""
    rows = [(i, "alpha beta gamma delta") for i in range(200)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows += [(held[0], "alpha beta gamma delta"), (held[1], "delta gamma beta alpha")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = language_model.language_model_scores(frame, RANKS, tokenizers_of.PATTERN, sample_bytes=0, corpus_weight=0.01, steps=0)
    scores = {r.doc_id: r.score for r in got.where("held_out").collect() if r.doc_id in held}
    assert scores[held[0]] > scores[held[1]] + 1


def coded(encoder, texts, wide=False):
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "held_out": [i % 4 == 1 for i in range(len(texts))], "text": texts})
    return pa.Table.from_batches(language_model._encode(encoder, wide)([batch]))


@pytest.mark.parametrize("wide", [False, True])
def test_encoded_texts_keep_words_and_ids(wide):
    encoder = language_model.Subwords(open(RANKS, "rb").read(), tokenizers_of.PATTERN)
    texts = [*odd_texts(), "é1ß" * 400 + " short " + "€" * 255 + " " + "x1" * 510]
    made = coded(encoder, texts, wide)
    read = language_model._Coded.of(made, wide)
    assert made["salt"].to_pylist() == list(dict.fromkeys(made["salt"].to_pylist()))
    spelled, kinds = [], {}
    for k, text in enumerate(texts):
        words = plain_words(text)
        assert read.first_word[k + 1] - read.first_word[k] == len(words)
        for n, word in enumerate(words, int(read.first_word[k])):
            assert read.ids[read.begin[n] : read.begin[n + 1]].tolist() == encoder.encode([word])[0].tolist()
            assert kinds.setdefault(word, read.number[n]) == read.number[n]
            spelled.append(word)
        assert (read.first[k], read.first[k + 1]) == (read.begin[read.first_word[k]], read.begin[read.first_word[k + 1]])
    assert len(spelled) == len(read.number) and len(set(kinds.values())) == len(kinds) == len(read.value)


def test_words_with_odd_white_space_keep_their_ids_among_others():
    encoder = language_model.Subwords(open(RANKS, "rb").read(), tokenizers_of.PATTERN)
    words = ["plain", "a\u00a0b", "\u2003", "x\x1cy", "it's", "日本", "...", "12,3", "é\u0301", "z\u3000", "\ufeffq", "😀😀", "<|endoftext|>"]
    ids, first = encoder.encode(words * 3)
    for k, word in enumerate(words * 3):
        assert ids[first[k] : first[k + 1]].tolist() == encoder._encoder.encode_ordinary(" " + word) == encoder.encode([word])[0].tolist()
    plain = [w for w in words if len(w.split()) == 1]
    ids, first = encoder.encode(plain)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [encoder._encoder.encode_ordinary(" " + w) for w in plain]
    assert [x.tolist() for x in encoder.encode([])] == [[], [0]]


def test_distinct_keys_equal_numpy():
    make = np.random.default_rng(3)
    for keys in (make.integers(0, 50, 1000), make.integers(0, 1 << 40, 5000), make.integers(0, 1 << 62, 300), np.zeros(0, np.int64), np.array([7])):
        got, want = language_model._distinct(keys), np.unique(keys, return_inverse=True)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_two_level_chances_add_up_to_one():
    make = np.random.default_rng(2)
    model = attention.Model(30)
    hidden = make.standard_normal((5, attention.HIDDEN)).astype(np.float32)
    group = hidden @ model.weights["out"]
    group = np.exp(group) / np.exp(group).sum(axis=1, keepdims=True)
    total = sum(group[:, k // attention.INNER] * np.exp(model.within(hidden, np.full(5, k))) for k in range(attention.CLASSES))
    assert total == pytest.approx(np.ones(5), rel=1e-5)


def test_token_pair_answers_by_brute_force():
    encoder = language_model.Subwords(open(RANKS, "rb").read(), tokenizers_of.PATTERN)
    texts = [[t or "" for t in odd_texts()[k::3]] for k in range(3)]
    tables = [coded(encoder, t).append_column("g", pa.array([k] * len(t), pa.int32())) for k, t in enumerate(texts)]
    tokens = max(encoder.pieces().values()) + 1
    words = attention.Vocabulary.of_counts(np.arange(tokens), np.arange(tokens) % 3 == 0)
    asked = pa.concat_tables([language_model._ask(5, False, words)(t) for t in tables])
    real, seen = Counter(), Counter()
    for group in texts:
        for i, text in enumerate(group):
            ids = [x for w in plain_words(text) for x in encoder.encode([w])[0].tolist()]
            for a, b in zip([tokens, *ids], ids):
                real[a, b] += i % 4 != 1
                seen[a, words.klass[b]] += i % 4 != 1
    met = set()
    for b in range(5):
        part = asked.filter(pa.compute.equal(asked["bucket"], b))
        answers = language_model._answer(words)(part)
        for keys, row in zip(part["pair"].to_pylist(), answers.to_pylist()):
            pairs = [(k // tokens // words.classes, k % tokens) for k in keys]
            assert row["together"] == [real[p] for p in pairs]
            own = list(dict.fromkeys((a, words.klass[t]) for a, t in pairs))
            assert row["seen"] == [seen[x] for x in own]
            met.update(pairs)
    assert met == set(real)


def test_model_goes_on_where_the_texts_are(spark):
    """The more training documents, the more steps; the average fits the texts better than the start."""
    encoder = language_model.Subwords(open(RANKS, "rb").read(), tokenizers_of.PATTERN)
    frame = spark.createDataFrame([("one two three four five six seven eight nine ten " * 40,)] * 60, "text string").repartition(2)
    read = language_model._Read(pa.array([r.text for r in frame.limit(3).collect()], pa.large_string()))
    ids, _, first = read.streams(*read.subwords(encoder))
    tokens = max(encoder.pieces().values()) + 1
    words = attention.Vocabulary.of_counts(np.bincount(ids, minlength=tokens), np.ones(tokens, bool))
    start = attention.Model(tokens)
    rows = frame.select(F.lit(1).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), "text")
    ids_of = rows.mapInArrow(language_model._encode(encoder, False), language_model._CODED_DDL)
    after = language_model.trained_on(ids_of, False, start, words)
    assert attention.token_scores(after, words, ids, first)[0].sum() > attention.token_scores(start, words, ids, first)[0].sum() + 1


# ---- 9 repeats


def test_repeats_by_brute_force(spark, unique):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in unique.collect())
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    found = repeats.repeated_passages(unique, group_bytes=2000)
    got = {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}
    for i, t in rows:
        cover = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                cover[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, c in zip(t, cover) if not c)
        spans = sum(1 for k in range(len(t)) if cover[k] and (k == 0 or not cover[k - 1]))
        assert got[i] == (len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot_strings", [0, 500, repeats.HOT])
def test_repeats_of_hot_anchors_are_spread_and_equal(spark, hot_strings):
    """A short line in random contexts, some of them repeated: the same bytes go, and no bucket has all strings of the line."""
    make = random.Random(2)
    noise = lambda n: "".join(make.choices("abcdefghij ", k=n))
    line, edges = "the same thirty bytes in each ", [noise(25) for _ in range(40)]
    texts = [noise(40) + make.choice(edges) + line + make.choice(edges) + noise(40) for _ in range(400)]
    first = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - 49):
            first.setdefault(t[k : k + 50], i)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.row.doc_id: r.n_removed for r in repeats.repeated_passages(frame, group_bytes=2000, hot_strings=hot_strings).collect()}
    for i, t in enumerate(texts):
        assert got[i] == len({at for k in range(len(t) - 49) if first[t[k : k + 50]] < i for at in range(k, k + 50)})


def test_strings_of_a_hot_anchor_go_to_many_buckets():
    make, buckets = random.Random(2), 16
    noise = lambda n: "".join(make.choices("abcdefghij ", k=n))
    tables = [
        pa.table({"g": pa.array([g] * 200, pa.int32()), "id": range(g * 200, g * 200 + 200), "text": [noise(40) + "the same thirty bytes in each " + noise(40) for _ in range(200)]})
        for g in range(2)
    ]
    asked = pa.concat_tables([repeats._ask(buckets, 50)(t) for t in tables])
    sent = {}
    for hot in (1000, 1 << 30):
        each = repeats._answer_first(50, hot)
        told = pa.concat_tables([each(asked.filter(pa.compute.equal(asked["bucket"], b))) for b in range(buckets)])
        runs = [repeats._ask_strings(buckets, 50)(t, told.filter(pa.compute.equal(told["g"], g))) for g, t in enumerate(tables)]
        sent[hot] = Counter()
        for r in pa.concat_tables(runs).to_pylist():
            sent[hot][r["bucket"]] += sum(r["count"])
    assert sum(sent[1000].values()) == sum(sent[1 << 30].values())
    assert max(sent[1000].values()) < max(sent[1 << 30].values()) / 3


def test_repeats_odd_rows(spark, docs):
    got = repeats.without_repeats(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert repeats.without_repeats(docs.limit(0)).count() == 0
    null = repeats.repeated_passages(docs).where("row.doc_id IS NULL").first()
    assert null.n_removed == 0


# ---- 10 pieces


def test_merges_agree_with_the_library(spark, docs):
    found = merges.library_agrees(docs, PIECES)
    assert found.count() == docs.count() and found.where("NOT agrees").count() == 0
    assert merges.library_agrees(spark.read.parquet(f"{SF}/documents.parquet"), PIECES).where("NOT agrees").count() == 0


def test_round_trip(spark, unique):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = collected(merges.round_trip_report(unique, PIECES), "n_tokens", "ids_sha256", "decoded_sha256")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in enumerate(odd_texts()):
        ids = library.encode(text or "")
        assert got[i * 3] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    back = collected(merges.decode(merges.encode(unique, PIECES), PIECES), "text")
    assert back[15] == ("One two",) and merges.encode(unique.limit(0), PIECES).count() == 0


def test_round_trip_fails_where_the_library_has_other_ids():
    merger = merges.Merger(merges.read_pieces(PIECES))
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in enumerate([*odd_texts(), "ends in a space ", " ", "  "])])
    assert sum(b.num_rows for b in merges._round_trip(merger)(iter([batch]))) == batch.num_rows
    merger.rank = merger.rank.max() - merger.rank
    with pytest.raises(ValueError, match="in the library"):
        list(merges._round_trip(merger)(iter([batch])))


# ---- the pipeline


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns, name
        before = after
    assert 0 < before.count() < docs.count()
    last = corpus_pipeline.run(spark, SF)
    assert last.count() == before.count() and "doc_id" in last.columns


def test_pipeline_stages_take_odd_rows(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).count()
        assert stage(spark, docs.limit(0), SF).count() == 0, name


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if re.match(r"op\d+_", n)))
def test_queries_return_a_row_for_each_input_row(spark, name):
    table = "embeddings" if name.startswith("op3_") else "documents"
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name.startswith("op11_"):
        rows = 600 * spark.read.parquet(f"{SF}/documents.parquet").select("lang").distinct().count()
    if name.startswith("op13_"):
        rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    assert entry.queries()[name](spark, SF).count() == rows


def test_attention_trains_on_every_document():
    from loomset.llm import attention

    counts = np.ones(40, np.int64)
    words = attention.Vocabulary.of_counts(counts, np.ones(40, bool))
    ids, first = np.arange(40), np.arange(0, 41, 4)
    inputs = attention.blocks(ids, first, 40)[0]
    seen, model = [], attention.Model(40, 0)
    model.gradients = lambda window, *_: (seen.append(window[:, attention.STRIDE :]), (0.0, {}))[1]
    attention.train(ids, first, words, steps=-(-len(inputs) // 4), batch=4, model=model)
    assert {tuple(w) for part in seen for w in part} == {tuple(w) for w in inputs}


def test_words_of_earlier_slices_are_not_spelled_again(monkeypatch):
    """A worker spells a word once; the ids are those of an encoder that knows nothing, also when it has to forget."""
    encoder = language_model.Subwords(open(RANKS, "rb").read(), tokenizers_of.PATTERN)
    texts = ["one two three", "two one four \u00c4\u00d6\u00dc", "a\u2003b one", "", "four five six seven one"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t]), pa.array([False])], names=["doc_id", "text", "held_out"])
        for i, t in enumerate(texts)
    ]
    spelled, plain = [], language_model.Subwords.encode
    monkeypatch.setattr(language_model, "_MADE", {})
    monkeypatch.setattr(language_model.Subwords, "encode", lambda self, words: (spelled.extend(words), plain(self, words))[1])
    rows = [r for b in language_model._encode(encoder, False)(batches) for r in b.to_pylist()]
    assert sorted(spelled) == sorted({w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)})
    for limit in (0, 2, 4):
        monkeypatch.setattr(language_model, "_KNOWN_WORDS", limit)
        monkeypatch.setattr(language_model, "_MADE", {})
        again = [r for b in language_model._encode(encoder, False)(batches) for r in b.to_pylist()]
        assert again == rows and len(next(iter(language_model._MADE.values())).known.value) <= limit
    want = [plain(encoder, t.split(" "))[0] if t else [] for t in texts]
    assert [np.frombuffer(r["ids"], np.uint16).tolist() for r in rows] == [list(w) for w in want]


def test_hashes_that_differ_in_their_last_bits_stay_apart():
    make = np.random.default_rng(4)
    for values in (make.integers(0, 1 << 63, 500), (7 << 40) + make.integers(0, 40, 500), [5, 4, 5, 4], [9], []):
        values = np.array(values, np.uint64)
        value, at, number = language_model._apart(values)
        want, number_of = np.unique(values, return_inverse=True)
        assert (value == want).all() and (values[at] == want).all() and (number == number_of).all()


def test_chances_of_scores_far_from_zero():
    """Scores are only lowered where exp would leave its range; chances and gradients are the same either way."""
    make = np.random.default_rng(5)
    scores, targets = make.standard_normal((16, 40)), make.integers(0, 16, 40)
    sums = np.ones((2, 16))
    sums[1, 8:] = 0
    want = scores - np.log(np.exp(scores).sum(0))
    for shift in (0, 100, -2000, np.where(np.arange(40) % 2, 500, -900)):
        got, starts = attention._ln_chance(scores + shift, targets, sums)
        assert got == pytest.approx(want[targets, np.arange(40)]) and starts[0] == pytest.approx(np.log(np.exp(want[:8]).sum(0)))
        back, _ = attention._softmax(scores + shift, targets, np.ones(40, bool), 40, False)
        assert back == pytest.approx((np.exp(want) - np.eye(16)[targets].T) / 40)


def test_attention_scores_equal_plain_ones():
    """Every token's chance as written down: attention over its window, the layer, its group and its place in the group."""
    make = np.random.default_rng(6)
    ids, first = make.integers(0, 30, 60), np.array([0, 37, 37, 60])
    words = attention.Vocabulary.of_counts(np.bincount(ids, minlength=30), make.random(30) < 0.5)
    model = attention.Model(30)
    w = model.weights = {k: (v + make.standard_normal(v.shape) * 0.3).astype(np.float32) for k, v in model.weights.items()}
    token, starts = attention.token_scores(model, words, ids, first, at_once=2, shares=np.zeros(60))
    want = []
    for a, b in zip(first[:-1], first[1:]):
        x = w["embed"][np.append(30, ids[a:b])]
        for i in range(b - a + 1):
            low = max(i // attention.STRIDE - 1, 0) * attention.STRIDE
            score = (x[low : i + 1] @ w["key"]) @ (x[i] @ w["query"]) / np.sqrt(attention.WIDTH) + w["bias"][i - np.arange(low, i + 1)]
            chance = np.exp(score) / np.exp(score).sum()
            hidden = np.maximum(chance @ (x[low : i + 1] @ w["value"]) @ w["mix"] + x[i] @ w["skip"] + w["mix_bias"], 0)
            group = np.exp(hidden @ w["out"] + w["out_bias"])
            start = np.log(group[: words.starts // attention.INNER].sum() / group.sum())
            if i == b - a:
                want.append((0.0, start))
                continue
            k, place = divmod(words.klass[ids[a + i]], attention.INNER)
            inner = np.exp(hidden @ w["inner"][k] + w["inner_bias"][k])
            want.append((np.log(group[k] / group.sum() * inner[place] / inner.sum()), start))
    assert np.allclose(np.array(want).T, [token, starts], atol=1e-4)
