"""The queries of this subpackage over the driver tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomset.llm import contamination, filter_audit, language_id, language_model, line_index, merges, near_text, near_vectors, quality, repair, repeats, token_files, trie_counts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


#: fixed values: lower-casing of A-Z alone, in SQL
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the pieces of the 32k vocabulary and their scores."""
    return trie_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    report = contamination.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return report.drop("longest_match")


_SQL["op2_decontaminate"] = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, p, n, item_id FROM doc_windows JOIN item_windows USING (n, g)),
hits AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on shingles of four words."""
    return near_text.near_duplicate_classes(_table(spark, sf_dir, "documents"), width=4)


_SQL["op4_minhash"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + least(len(w), 4) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * c >= 80 * (s.n + t.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM words
  UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
lowest AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM words LEFT JOIN sizes USING (doc_id) JOIN lowest USING (doc_id)
"""


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids, read back from token files."""
    return token_files.token_file_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier document has in a string of 50."""
    found = repeats.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query
def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text decoded from them."""
    return merges.round_trip_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return language_model.language_model_scores(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language_id.language_report(_table(spark, sf_dir, "documents"))


@_query
def op3_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all vectors of equal label."""
    return near_vectors.near_vector_classes(_table(spark, sf_dir, "embeddings"))


_SQL["op3_caps"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM usable x JOIN usable y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE x.norm > 0 AND y.norm > 0 AND list_inner_product(x.v, y.v) / (x.norm * y.norm) >= 0.93),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r),
lowest AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM lowest LEFT JOIN counts USING (vec_id)
"""


@_query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at each step of each order, by language."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_SQL["op11_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copied
  FROM documents),
flags AS (
  SELECT doc_id, part,
         CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(copied AS INT) AS m
  FROM texts),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
kinds AS (
  SELECT part, m, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT concat(a.l, b.l, c.l, d.l, e.l) AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT o, CAST(s AS INT) AS s, CAST(1 << (ascii(o[s]) - 65) AS BIGINT) AS f,
         CAST(list_sum([0] || list_transform(string_split(o[1 : s - 1], ''), lambda c: CASE WHEN c = '' THEN 0 ELSE 1 << (ascii(c) - 65) END)) AS BIGINT) AS b
  FROM orders, range(1, 6) r(s)),
counted AS (
  SELECT part, o, s, f,
         coalesce(sum(n) FILTER (m & (b | f) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (m & f > 0 AND m & b = 0), 0) AS removed,
         coalesce(sum(n) FILTER (m & f > 0 AND m & b > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (m = f), 0) AS unique_fails,
         coalesce(sum(good) FILTER (m & f > 0 AND m & b = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (m & f > 0 AND m & b = 0), 0) AS toxic_lost
  FROM kinds, steps GROUP BY part, o, s, f)
SELECT part, o AS filter_order, s AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


@_query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in three documents or more, kept in the last of them alone."""
    return line_index.line_dedup_report(_table(spark, sf_dir, "documents"))


_SQL["op12_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, p, l[p] AS line,
         translate(trim(l[p], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM split)),
frequent AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (coalesce(doc_id <> last, false)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT coalesce(doc_id <> last, false)), '')) AS kept_sha256
FROM lines LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


@_query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    return repair.repaired(_table(spark, sf_dir, "conversations"))


def _plus(state: str, cost: int | str, letter: str) -> str:
    """SQL for a state, eight digits of cost and then the audit, after one more edit."""
    return f"(lpad(CAST(CAST(left({state}, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({state}, 9) || {letter})"


def _inserted(prefix: str) -> list[str]:
    """SQL for the four states after the cheapest insertions."""
    nothing, system, user, assistant = (f"{prefix}{k}" for k in range(4))
    one, two = (lambda x: _plus(x, 3, "'I'")), (lambda x: _plus(x, 6, "'II'"))  # noqa: E731
    return [
        nothing, system, f"least({user}, {one(nothing)}, {one(system)}, {one(assistant)})",
        f"least({assistant}, {one(user)}, {two(nothing)}, {two(system)})",
    ]


def _edited() -> list[str]:
    """SQL for the four states after a row was kept, reroled or deleted."""
    may = lambda then: f"CASE WHEN fault IN ('blank', 'duplicate') THEN NULL ELSE {then} END"  # noqa: E731
    more = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"

    def to(role: str, sources: str) -> str:
        cost, letter = f"{more} + CASE WHEN c = '{role}' THEN 0 ELSE 3 END", f"CASE WHEN c = '{role}' THEN 'K' ELSE 'R' END"
        return may("least(" + ", ".join([_plus(f"i{k}", cost, letter) for k in sources] + ["NULL"]) + ")")

    gone = [_plus(f"i{k}", 4, "'D'") for k in range(4)]
    kept = f"CASE WHEN c = 's' THEN {_plus('i0', more, chr(39) + 'K' + chr(39))} END"
    return [gone[0], f"least({gone[1]}, {may(kept)})", f"least({gone[2]}, {to('u', '013')})", f"least({gone[3]}, {to('a', '2')})"]


# crc32 bit by bit; the states of each conversation row by row; then the edits of the best audit beside its rows
_SQL["op13_repair"] = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '') AS letters
  FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(letters, lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
      lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE kind <> 0),
placed AS (
  SELECT *, left(role, 1) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM damaged),
judged AS (
  SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY n) || c AS pair,
         CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
facts AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, '00000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM facts
  UNION ALL
  SELECT conv_id, n + 1, {', '.join(_edited())}
  FROM (SELECT walk.conv_id, walk.n, {', '.join(f"{x} AS i{k}" for k, x in enumerate(_inserted('s')))}, j.c, j.fault
        FROM walk JOIN judged j ON j.conv_id IS NOT DISTINCT FROM walk.conv_id AND j.n = walk.n + 1) t),
best AS (
  SELECT w.conv_id, least(s0, {_inserted('s')[3]}) AS found FROM walk w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rows = w.n),
edits AS (
  SELECT conv_id, e[p] AS e, p, len(list_filter(e[1 : p], lambda x: x <> 'I')) AS n, len(list_filter(e[1 : p], lambda x: x <> 'D')) - 1 AS made,
         len(list_filter(e, lambda x: x <> 'D')) % 2 AS odd
  FROM (SELECT conv_id, e, unnest(range(1, len(e) + 1)) AS p FROM (SELECT conv_id, string_split(substr(found, 9), '') AS e FROM best WHERE length(found) > 8))),
made AS (
  SELECT e.conv_id, string_agg(CASE WHEN e.e = 'K' THEN j.role WHEN (e.made + e.odd) % 2 = 0 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN e.e = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY e.p) AS text
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.n = e.n AND e.e <> 'I' WHERE e.e <> 'D' GROUP BY e.conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(left(found, 8) AS BIGINT), 0) AS cost, coalesce(substr(found, 9), '') AS audit,
       sha256(coalesce(m.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN made m ON m.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)
