"""The quality learner and every stage of the pipeline against plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers as tokenizers_of
import pyarrow as pa
import pytest
import regex
import sentencepiece

import corpus_pipeline
from loomset.llm import quality


# ---- the quality learner


class PlainLeader:
    """Follow the regularised leader on dictionaries, one coordinate at a time."""

    def __init__(self, alpha=0.3, beta=1.0, l1=0.02, l2=1e-3):
        self.alpha, self.beta, self.l1, self.l2, self.z, self.n = alpha, beta, l1, l2, {}, {}

    def weight(self, i):
        z = self.z.get(i, 0.0)
        if abs(z) <= self.l1:
            return 0.0
        return -(z - math.copysign(self.l1, z)) / ((self.beta + math.sqrt(self.n.get(i, 0.0))) / self.alpha + self.l2)

    def learn(self, example, label):
        example = {**example, "bias": 1.0}
        weights = {i: self.weight(i) for i in example}
        chance = 1 / (1 + math.exp(-sum(weights[i] * v for i, v in example.items())))
        for i, v in example.items():
            slope, n = (chance - label) * v, self.n.get(i, 0.0)
            rate = (math.sqrt(n + slope * slope) - math.sqrt(n)) / self.alpha
            self.z[i] = self.z.get(i, 0.0) + slope - rate * weights[i]
            self.n[i] = n + slope * slope


def test_learner_equals_plain_follow_the_regularised_leader():
    make = random.Random(4)
    mine, plain = quality.Leader(), PlainLeader()
    for _ in range(400):
        example = {make.randrange(60): make.random() * 3 for _ in range(make.randint(0, 9))}
        label = int(sum(example.get(k, 0) for k in range(5)) > make.random())
        mine.learn(np.array(list(example), np.int64), np.array(list(example.values())), label)
        plain.learn(example, label)
    weights = mine.weights()
    assert weights[:60] == pytest.approx([plain.weight(k) for k in range(60)], abs=1e-12)
    assert weights[-1] == pytest.approx(plain.weight("bias")) and not weights[60:-1].any()


def test_scores_equal_a_plain_dot_product(spark):
    make = random.Random(5)
    parts = ["good", "BAD", "x1", "é", "日本", "!!", "...", "a,b", "--x--", "good good"]
    texts = [None, "", " \n", "one", "! !", *(" ".join(make.choices(parts, k=make.randint(1, 40))) for _ in range(40)), "long word " * 3000]
    weights = np.random.default_rng(1).standard_normal((1 << quality.BITS) + 1) * 0.3
    single = lambda t: int(quality.features(pa.array([t]))[0][0])
    pair = lambda a, b: int(quality.features(pa.array([f"{a} {b}"]))[1][0])
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in quality.scored(rows, weights).collect()}
    for i, text in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        tokens = re.findall("[0-9a-z\\x80-\\U0010FFFF]+|[^0-9a-z\\x80-\\U0010FFFF\\x20\\x09-\\x0d]+", low)
        total = sum(weights[single(t)] for t in tokens) + sum(weights[pair(a, b)] for a, b in zip(tokens, tokens[1:]))
        score = total * quality.SCALE / max(len(tokens), 1) + weights[-1]
        assert got[i] == pytest.approx(1 / (1 + math.exp(-min(max(score, -35), 35))), abs=1e-9), i


# ---- the pipeline


def documents():
    make = random.Random(8)
    words = [make.choice("abcdeéß") * make.randint(1, 4) + make.choice(["", "x", "1", "."]) for _ in range(60)]
    text = lambda n: " ".join(make.choice(words) for _ in range(n))
    shared, long = text(40), text(2000)
    near, cut = shared.split(), "é" * 70
    rows = [None, "", "  \n\t", "?! 123", "one", "One two", "日本語 テキスト 😀", "a" * 3000, long, long, long + " zz", shared, shared.upper()]
    rows += [" ".join(near[:39] + [f"w{k}"]) for k in range(9)] + [" ".join(near[: 8 * k]) for k in range(1, 6)]
    rows += [text(12) + " " + shared + " " + text(9) for _ in range(5)] + [text(make.randint(1, 90)) for _ in range(25)]
    rows += ["x" + cut, "y" + cut + "z", "ab" + cut + text(5), "x y z", "▁ a  b ▁", "it's x <s> </s> <0x41>   é"]
    bench = [(1, " ".join(text(14).split())), (2, "X, Y"), (3, None), (4, "?!"), (None, "one two"), (5, " ".join(long.split()[50:65]))]
    return [(i * 3, t, "en", "s", len(t or "")) for i, t in enumerate(rows)], bench


def has_letter(rows):
    return [r for r in rows if r[1] is not None and regex.search(r"\p{L}", r[1])]


def one_of_each_group(rows):
    sets = {}
    for i, text, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = [w for w in re.split("[\\x20\\x09-\\x0d]+", low) if w]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [r for r in rows if root(r[0]) == r[0]]


def without_repeats(rows):
    first = {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        data = text.encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], i)
    out = []
    for i, text, lang, source, _ in rows:
        data = text.encode()
        cover = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < i:
                cover[k : k + 50] = b"\1" * 50
        # a character stays whole unless all of its bytes go
        kept, at = [], 0
        for char in text:
            size = len(char.encode())
            if not all(cover[at : at + size]):
                kept.append(char)
            at += size
        out.append((i, "".join(kept), lang, source, len(kept)))
    return out


def without_benchmark(rows, bench):
    words_of = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for _, text in bench:
        words = words_of(text)
        size = min(len(words), 10)
        windows |= {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()

    def clean(text):
        words = words_of(text)
        return not any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1))

    return [r for r in rows if clean(r[1])]


def test_every_stage_equals_plain_python(spark, tmp_path):
    rows, bench = documents()
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = {
        "language": has_letter, "near_duplicates": one_of_each_group, "repeated_passages": without_repeats,
        "decontaminate": lambda r: without_benchmark(r, bench),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(rows, kind).repartition(3)
        got = sorted(tuple(r) for r in stage(spark, frame, str(tmp_path)).collect())
        want = sorted(plain[name](rows))
        assert got == want, name
        # each stage has something to do here, and the next one something left
        assert want and want != sorted(rows), name
        rows = want
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers_of.path("piece_bpe_32k.model"))
    name, stage = corpus_pipeline.STAGES[-1]
    got = {r.doc_id: r for r in stage(spark, spark.createDataFrame(rows, kind), str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = library.encode(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_the_whole_pipeline_equals_plain_python(spark, tmp_path):
    rows, bench = documents()
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    kept = without_benchmark(without_repeats(one_of_each_group(has_letter(rows))), bench)
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizers_of.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = {i: library.encode(text) for i, text, *_ in kept}
    assert got == {i: (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for i, ids in want.items()}
