"""Term vectors, the chunk table function, NFKC only where it matters, copies kept apart without moving texts."""

import hashlib
import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.functions import chunk_rows
from loomset.functions import chunks as C
from loomset.functions import text as T
from loomset.operators import embed as E
from loomset.operators import neardup as N


def odd_texts():
    make = random.Random(9)
    words = ["Word", "and", "é", "日本", "x;", "a:", "then,", "or", "but", "end.", "What?", "No!", "—", "--", " ", "\n", "3", "(b)", ", and so", ", but it"]
    rows = [None, "", "  \n", "one", "Short text. Fits.", "a" * 5000, "w " * 700, "Only; clauses: here, and there, but no end " * 60]
    rows += [" ".join(make.choices(words, k=make.choice([5, 80, 400, 900]))) for _ in range(60)]
    return rows + ["No stop " * 400 + ". Then one. " + "b; c, and d " * 300, ".A.B.C", "x. Y. Z.", "End. Next. \x1cThird"]


@pytest.mark.parametrize("most", [5, 40, 480])
def test_chunk_table_function_equals_the_column_function(spark, most):
    rows = spark.createDataFrame(list(enumerate(odd_texts())), "i long, t string").repartition(3)
    chunk_rows.register(spark, "cut_text")
    got = spark.sql("SELECT i, c.* FROM {rows} r, LATERAL cut_text(r.t, {most}) c", rows=rows, most=most).collect()
    want = rows.select("i", F.posexplode(C.chunk_greedy(F.col("t"), most)).alias("n", "chunk")).collect()
    assert sorted((r.i, r.chunk_no, r.chunk) for r in got) == sorted((r.i, r.n + 1, r.chunk) for r in want)
    assert len(want) > 100
    whole = spark.sql("SELECT * FROM cut_text('One. Two.', 480)").collect()
    assert [(r.chunk_no, r.chunk) for r in whole] == [(1, "One. Two.")]


def test_term_vectors_equal_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    frame = spark.createDataFrame(rows, "i long, t string").repartition(3)
    counts = np.zeros((len(rows), 64))
    for i, t in rows:
        for token in re.findall(r"\w+", (t or "").lower()):
            counts[i, int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 64] += 1
    weights = np.array([math.log((len(rows) + 1) / ((counts[:, k] > 0).sum() + 1)) for k in range(64)])
    assert E.term_weights(frame, "t").first()["weights"] == pytest.approx(weights.tolist())
    for made, want in ((E.term_vectors(frame, "t"), counts), (E.term_vectors(frame, "t", E.term_weights(frame, "t")), counts * weights)):
        length = np.linalg.norm(want, axis=1, keepdims=True)
        want = np.divide(want, length, out=np.zeros_like(want), where=length > 0)
        got = np.array([r.vec for r in made.orderBy("i").collect()])
        assert np.allclose(got, want, atol=1e-6)
    plan = E.term_vectors(frame, "t", E.term_weights(frame, "t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_nfkc_leaves_the_jvm_only_for_texts_it_might_change(spark):
    make, beyond = random.Random(4), []
    for _ in range(400):
        chars = [chr(make.choice([make.randint(32, 126), make.randint(0xA0, 0x24F), make.randint(0x300, 0x4FF), make.randint(0x1100, 0x11FF),
                                  make.randint(0x2000, 0x21FF), make.randint(0x3000, 0x33FF), make.randint(0xAC00, 0xAC40), make.randint(0xFF00, 0xFFEF)]))
                 for _ in range(make.randint(1, 6))]
        beyond.append("".join(chars))
    beyond += ["été", "é", "ﬁ", "①", "가", "각", "が", "が", "日本", "…", "½", "Ａ", "क़", "😀"]
    frame = spark.createDataFrame([(t,) for t in beyond], "t string")
    for r in frame.select("t", T.unicode_form_of(F.col("t")).alias("n"), F.regexp_replace("t", r"[\x00-\x7F]+", "").rlike(T._UNSTABLE).alias("sent")).collect():
        assert r.n == unicodedata.normalize("NFKC", r.t)
    calm = spark.createDataFrame([("Été à Zürich, “dans” l’eau – 5 €",), ("Привет, мир",), ("日本語のテキスト",), ("한국어",)], "t string")
    assert calm.where(F.regexp_replace("t", r"[\x00-\x7F]+", "").rlike(T._UNSTABLE)).count() == 0


def test_texts_stay_where_they_are_when_copies_are_few(spark):
    rows = spark.createDataFrame([(i, f"text {i % 90} of some words") for i in range(100)], "id long, t string")
    reps, links = N.distinct_texts(rows, "id", "t")
    assert sorted(r.id for r in reps.collect()) == list(range(90))
    assert {(r.rep, r.id) for r in links.collect()} == {(i, i + 90) for i in range(10)}
    plan = reps._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
