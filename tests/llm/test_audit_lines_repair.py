"""Filter audit, reversible line dedup and conversation repair against plain Python."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomset.llm import filter_audit, line_index, repair
from loomset.llm.cuckoo import CuckooFilter

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 filter audit


def audited(docs, labels):
    """The audit by its definition; docs are (doc_id, text, lang), labels (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split("[\\x20\\x09-\\x0d]+", text) if w]
        fails = "".join(k for k, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search("[#$%&*|]", text) is not None, i is not None and first[text] < i)) if bad)
        parts[lang or ""].append((fails, i in good, i in toxic))
    out, orders = {}, ["".join(p) for p in permutations("ABCDE")]
    for part, rows in parts.items():
        total = Counter()
        for order in orders:
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                failing = [r for r in rows if f in r[0]]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[0] == f for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for order in orders:
            for step, f in enumerate(order, 1):
                out[part, order, step].append(total[f])
    return out


def audit_rows(frame):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in frame.collect()}


def odd_documents():
    make = random.Random(11)
    words = ["Ab", "cd", "é", "日本", "x#", "Q", "long", "word"]
    docs = [(None, "same text", "en"), (None, "same text", "en"), (1, None, None), (2, "", "en"), (3, "", "en"), (3, "", "en"), (4, " \t\n", "de")]
    docs += [(10 + k, " ".join(make.choices(words, k=make.choice([3, 199, 200, 400]))), make.choice(["en", "de", None])) for k in range(60)]
    docs += [(100 + k, make.choice(docs)[1], "en") for k in range(20)] + [(5, "same text", "en"), (0, "y" * 70000, "x y`")]
    docs += [(200, " ".join(f"w{k}" for k in range(300)), "en"), (201, "A" + "b" * 32, "en"), (202, "AB" + "c" * 65, "en")]
    labels = [(k, make.randint(0, 1), make.choice([0, 1, None])) for k in range(0, 120)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (7777, 1, 1)]
    return docs, labels


def test_filter_audit_equals_its_definition(spark):
    docs, labels = odd_documents()
    frame = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, lang string, part string, `a.b` int").withColumn("fails", F.lit(1)).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert audit_rows(filter_audit.filter_audit(frame, marks)) == audited(docs, labels)
    assert filter_audit.filter_audit(frame.limit(0), marks).count() == 0
    unlabelled = audit_rows(filter_audit.filter_audit(frame, marks.limit(0)))
    assert unlabelled == {k: v[:4] + [0, 0] + v[6:] for k, v in audited(docs, []).items()}


def test_filter_audit_with_a_hot_text_and_part(spark, monkeypatch):
    docs = [(k, "hot" if k % 2 else f"text {k % 50}", "en" if k % 3 else "de") for k in range(3000)] + [(None, "hot", "en")] * 40
    labels = [(k, k % 2, int(k % 7 == 0)) for k in range(0, 3000, 3)]
    monkeypatch.setattr(filter_audit, "TASK_ROWS", 200)
    got = filter_audit.filter_audit(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert audit_rows(got) == audited(docs, labels)


def test_galloping_search_equals_binary_search():
    make = np.random.default_rng(1)
    for n, m in ((0, 5), (5, 0), (1, 1), (1000, 3), (3, 1000), (5000, 5000), (100000, 200)):
        values, keys = np.unique(make.integers(0, 20000, n)), np.unique(make.integers(0, 20000, m))
        assert filter_audit.gallop(values, keys).tolist() == np.searchsorted(values, keys).tolist()
        assert filter_audit.merged([values, keys, values[::7]]).tolist() == np.union1d(values, keys).tolist()
        assert keys[filter_audit.found_in(keys, values)].tolist() == np.intersect1d(keys, values).tolist()


def test_posting_lists_hold_every_row_once(spark):
    rows = spark.createDataFrame([(k % 100, "p" if k % 4 else "q", k % 32) for k in range(500)], "doc_id long, part string, fails int")
    lists = filter_audit.posting_lists(rows).collect()
    assert sum(len(r.ids) for r in lists) == 500 and all(list(r.ids) == sorted(r.ids) for r in lists)
    for f in range(5):
        got = Counter((r.part, r.ids[at]) for r in lists for at in r.places[f])
        assert got == Counter(("p" if k % 4 else "q", k % 100) for k in range(500) if k % 32 >> f & 1)


# ---- 12 line dedup


def deduped(docs, min_docs=3):
    """Line dedup by its definition; docs are (doc_id, text)."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return Counter(out)


def line_documents(n=80):
    make = random.Random(12)
    lines = [f"this is the line of number {k}" for k in range(12)] + ["  THIS is the line of number 3\t", "short", "", "   ", "é" * 20, "É" * 19, "日本語" * 7,
             "a line with a carriage return\r", "\x0ba vertical tab and a line \x0c", "x" * 50000]
    docs = [(k, "\n".join(make.choices(lines + [f"only in document {k} {make.random()}"] * 9, k=make.randint(1, 12)))) for k in range(n)]
    docs += [(None, lines[0]), (None, "\n".join(lines)), (500, None), (501, ""), (502, "\n\n"), (503, lines[1]), (503, lines[1] + "\n" + lines[1]), (-4, lines[2] + "\n")]
    return docs


def line_rows(frame):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect())


def test_line_dedup_equals_its_definition(spark):
    docs = line_documents()
    frame = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, low string, `a b` int").withColumn("drops", F.lit(1)).repartition(3)
    assert line_rows(line_index.line_dedup_report(frame)) == deduped(docs)
    assert line_index.line_dedup_report(frame.limit(0)).count() == 0
    texts = line_index.LineIndex.of(frame).cleaned(frame, with_text=True).collect()
    assert all(sha(r.kept_text) == r.kept_sha256 for r in texts)


def test_line_dedup_with_a_line_in_every_document(spark, monkeypatch):
    monkeypatch.setattr(line_index, "ASKED_LINES", 64)
    monkeypatch.setattr(line_index, "SHARD_KEYS", 50)
    docs = [(k, f"a line that all documents have\nbut this one is of {k // 2} and its twin") for k in range(1500)]
    assert line_rows(line_index.line_dedup_report(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))) == deduped(docs)


def state(index):
    counts = {(r.low, r.high): (r.n_docs, r.largest) for r in index.counts.collect()}
    refs = sorted((r.low, r.high, r.doc_id) for r in index.refs.collect())
    return counts, refs, {(r.doc_id, tuple(sorted(r.drops))) for r in index.drops().collect()}


def test_insertions_and_deletions_are_exact_and_reversible(spark, monkeypatch):
    monkeypatch.setattr(line_index, "SHARD_KEYS", 8)
    docs = line_documents()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    early, late = frame.where("doc_id % 3 <> 0 OR doc_id IS NULL"), frame.where("doc_id % 3 = 0")
    index = line_index.LineIndex.of(early)
    before = state(index)
    both = index.insert(late)
    assert line_rows(both.cleaned(frame)) == deduped(docs)
    assert state(both.insert(early))[:2] == state(both)[:2]
    back = both.delete(late.select("doc_id"))
    assert state(back) == before
    assert line_rows(back.cleaned(early)) == deduped([(i, t) for i, t in docs if i is None or i % 3])
    empty = back.delete(frame.select("doc_id"))
    assert state(empty) == ({}, [], set()) and empty.filters.where("n_keys > 0").count() == 0
    # the filters know all frequent keys and, after deletions, few others
    frequent = both.counts.where("n_docs >= 3").withColumn("doc_id", F.lit(1))
    assert both.known(frequent.select("low", "high", F.col("doc_id").cast("long").alias("doc_id"))).count() == frequent.count()


def test_cuckoo_filter_adds_and_removes():
    make = np.random.default_rng(3)
    low, high = (make.integers(0, 1 << 63, 6000).astype(np.uint64) for _ in range(2))
    made = CuckooFilter.of(low[:3000], high[:3000])
    assert made.contains(low[:3000], high[:3000]).all()
    assert made.contains(low[3000:], high[3000:]).mean() < 0.005
    made.remove(low[:1500], high[:1500])
    assert made.contains(low[1500:3000], high[1500:3000]).all()
    assert made.contains(low[:1500], high[:1500]).mean() < 0.005
    again = CuckooFilter.read(made.to_bytes())
    assert again.add(low[:1000], high[:1000]) and again.contains(low[:1000], high[:1000]).all()
    assert not CuckooFilter(2).add(low, high)
    with pytest.raises(ValueError):
        CuckooFilter(4).remove(low[:1], high[:1])


# ---- 13 conversation repair


def damage(rows):
    """Rows (conv_id, turn, role, text) after the damage, in order."""
    out = []
    said = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    content = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, content(r)))


def shortest(rows, faults):
    """Least (cost, audit) and the repaired rows, by a search over (rows read, roles written)."""
    start = (0, "", 0, "", ())
    heap, done = [start], set()
    while heap:
        cost, audit, at, state, made = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, made
        steps = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in steps.replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", at, role, made + (({"u": "user", "a": "assistant"}[role], ""),)))
        if at < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state, made))
            if faults[at] not in ("blank", "duplicate"):
                more, (_, _, role, text) = 3 * (faults[at] == "truncated"), rows[at]
                for new in steps:
                    if role[:1] == new:
                        heapq.heappush(heap, (cost + more, audit + "K", at + 1, new, made + ((role, text),)))
                    if new != "s":
                        heapq.heappush(heap, (cost + more + 3, audit + "R", at + 1, new, made + (({"u": "user", "a": "assistant"}[new], text),)))


def repaired(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    out = {}
    for conv, mine in groups.items():
        left = damage(mine)
        seen, faults = set(), []
        for _, _, role, text in left:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in left if r[1] is not None]
        starts = [r[2][:1] for r in left]
        cost, audit, made = shortest(left, faults) if left else (0, "", ())
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:])), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in made)))
    return out


def repaired_rows(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


CONV = "conv_id long, turn long, role string, text string"


def odd_conversations(n=300, seed=13):
    make = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "u", "usher", "User", "日本"]
    texts = ["Hello.", "Yes!", "no end", "Why?  \n", "", " \t", None, "...", "a\nb.", "é?"]
    rows = []
    for conv in range(n):
        turns = [make.choice([None, *range(12)]) if make.random() < 0.1 else k for k in range(make.randint(1, 9))]
        for k, turn in enumerate(turns):
            role = ["user", "assistant"][k % 2] if make.random() < 0.6 else make.choice(roles)
            rows.append((conv, turn, role, f"t{k}." if make.random() < 0.5 else make.choice(texts)))
    rows += make.choices(rows, k=30) + [(None, k, make.choice(roles), make.choice(texts)) for k in range(8)] + [(10_000, None, None, None)] * 3
    return rows + [(10_001, -(1 << 63), "user", "a."), (10_001, (1 << 63) - 1, "assistant", "b.")]


def test_repair_equals_a_shortest_path_search(spark):
    rows = odd_conversations()
    want = repaired(rows)
    want[10_001] = ((want[10_001][0] + (1 << 63)) % (1 << 64) - (1 << 63), *want[10_001][1:])
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV + ", tag int, `a.b c` string").repartition(3)
    assert repaired_rows(repair.repaired(frame)) == want
    assert repair.repaired(frame.limit(0)).count() == 0
    assert any(v == (0, 0, 0, 0, 0, 0, "", sha("")) for v in want.values())


def test_repair_of_a_conversation_that_holds_most_rows(spark, monkeypatch):
    make = random.Random(7)
    rows = [(1, k, make.choice(["user", "assistant", "assistant", "system"]), make.choice(["ok.", f"t{k}.", "cut", ""])) for k in range(2500)]
    rows += odd_conversations(60, 3) + [(2, 5, "user", "the same again.")] * 900
    monkeypatch.setattr(repair, "TASK_ROWS", 100)
    key, now = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "50")
    try:
        assert repaired_rows(repair.repaired(spark.createDataFrame(rows, CONV).repartition(4))) == {
            k: (((v[0] + (1 << 63)) % (1 << 64) - (1 << 63)), *v[1:]) for k, v in repaired(rows).items()}
    finally:
        spark.conf.set(key, now)


def test_split_point_of_a_span_does_not_matter():
    make = random.Random(2)
    for _ in range(50):
        cells = [repair.row_cell(make.choice(["s", "u", "a", "x"]), make.random() < 0.2, make.random() < 0.3) for _ in range(9)]
        whole = repair.combined(cells)
        for cut in range(1, 9):
            assert repair.product(repair.combined(cells[:cut]), repair.combined(cells[cut:])) == whole


def test_string_ids_and_the_given_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert repaired_rows(entry.queries()["op13_repair"](spark, SF)) == repaired(rows)
    named = [(f"c {c}", t, r, x) for c, t, r, x in rows]
    frame = spark.createDataFrame(named, CONV.replace("conv_id long", "conv_id string"))
    assert repaired_rows(repair.repaired(frame)) == repaired(named)
