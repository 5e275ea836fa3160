"""Text functions: tokens, sentences, chunks, labels, classes, rewriting."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.functions import chunks as C
from loomset.functions import classify as K
from loomset.functions import labels as L
from loomset.functions import patterns as P
from loomset.functions import rewrite as RW
from loomset.functions import text as T
from loomset.functions import vectors as VF
from loomset.functions.masks import mask_pattern as mask
from loomset.operators import phrases as PH
from loomset.operators import vectors as V
from loomset.sources.readers import document_of_chunk

from . import sqltext as S
from .evaluating import SQL_GOLD, combos, sql_mask
from .joining import vecs
from .registry import query, quoted, table, texts
from .views import doc_labels


def docs(spark, sf):
    return texts(spark, sf)


def sql_terms(text, terms):
    return "(" + " + ".join(f"CASE WHEN contains({text}, {quoted(t)}) THEN 1 ELSE 0 END" for t in terms) + ")"


def sql_list(items):
    return "[" + ", ".join(quoted(i) for i in items) + "]"


@query("est_tokens_words", f"SELECT doc_id, {S.est_tokens()} AS tokens FROM documents")
def est_tokens_words(spark, sf):
    return docs(spark, sf).select("doc_id", T.est_tokens_words(F.col("text")).alias("tokens"))


@query("est_tokens_chars", "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents")
def est_tokens_chars(spark, sf):
    return docs(spark, sf).select("doc_id", T.est_tokens_chars(F.col("text")).alias("tokens"))


@query("tokenize_words", f"SELECT doc_id, array_to_string({S.tokens()}, ' ') AS tokens FROM documents")
def tokenize_words(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens"))


SQL_MARKED = f"regexp_replace(text, {quoted('([.!?])' + P.WS + '+([A-Z])')}, {quoted(chr(92) + '1' + C.CUT + chr(92) + '2')}, 'g')"


@query("split_sentences", f"""
SELECT doc_id, array_to_string(list_filter(list_transform(string_split({SQL_MARKED}, '{C.CUT}'), lambda s: {S.strip('s')}), lambda s: s <> ''), '{C.CUT}') AS at_capitals,
       array_to_string({S.sentences()}, '{C.CUT}') AS at_marks FROM documents""")
def split_sentences(spark, sf):
    return docs(spark, sf).select(
        "doc_id", F.array_join(C.sentences_at_capitals(F.col("text")), C.CUT).alias("at_capitals"),
        F.array_join(C.sentences_at_marks(F.col("text")), C.CUT).alias("at_marks"))


def sql_marked_clauses(text):
    for pattern in P.CLAUSE_BREAKS:
        text = f"regexp_replace({text}, {quoted('(' + pattern + ')')}, {quoted(chr(92) + '1' + C.CUT)}, 'g')"
    return text


# the merge of short clauses is a fold in document order
@query("split_clauses", f"""
WITH RECURSIVE s AS (SELECT doc_id, unnest({S.sentences()}) AS s, generate_subscripts({S.sentences()}, 1) AS sentence FROM documents),
c AS (SELECT doc_id, sentence, list_filter(list_transform(string_split({sql_marked_clauses('s')}, '{C.CUT}'), lambda x: {S.strip('x')}), lambda x: x <> '') AS cs FROM s),
u AS (SELECT doc_id, sentence, unnest(cs) AS clause, generate_subscripts(cs, 1) AS i FROM c),
g AS (SELECT *, sum(CASE WHEN i = 1 OR {S.word_count('clause')} >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, sentence ORDER BY i) AS grp FROM u)
SELECT doc_id, CAST(sentence AS BIGINT) AS sentence, CAST(grp AS BIGINT) AS clause_no, string_agg(clause, ' ' ORDER BY i) AS clause FROM g GROUP BY doc_id, sentence, grp""")
def split_clauses(spark, sf):
    sentences = docs(spark, sf).select("doc_id", F.posexplode(C.sentences_at_marks(F.col("text"))).alias("i", "s"))
    clauses = sentences.select("doc_id", (F.col("i") + 1).cast("long").alias("sentence"), F.posexplode(C.split_clauses(F.col("s"))).alias("j", "clause"))
    return clauses.select("doc_id", "sentence", (F.col("j") + 1).cast("long").alias("clause_no"), "clause")


_UNITS_SQL = quoted("|".join(f"(?:{u})" for u in C.UNITS))


@query("protect_units", f"""
WITH n AS (SELECT doc_id, text || ' Due 01/02/2024. Call (555) 123-4567 at 10:30 pm. Pay $1,250.50 by May 3, 2024.' AS text FROM documents),
x AS (SELECT doc_id, regexp_extract_all(text, {_UNITS_SQL}) AS units FROM n)
SELECT doc_id, CAST(len(units) AS BIGINT) AS units, array_to_string(list_transform(units, lambda u: regexp_replace(u, {quoted(P.WS)}, '_', 'g')), '|') AS held, true AS restored FROM x""")
def protect_units(spark, sf):
    noted = docs(spark, sf).withColumn("text", F.concat(
        "text", F.lit(" Due 01/02/2024. Call (555) 123-4567 at 10:30 pm. Pay $1,250.50 by May 3, 2024.")))
    found = noted.withColumn("found", C.units_of(F.col("text")))
    held = found.select("doc_id", "text", "found", C.protect_units(F.col("text"), F.col("found")).alias("p"))
    return held.select(
        "doc_id", F.size("found").cast("long").alias("units"),
        F.array_join(F.transform("found", lambda u: F.replace(F.regexp_replace(u, P.WS, C.HELD), F.lit(C.HELD), F.lit("_"))), "|").alias("held"),
        (C.restore_units(F.col("p")) == F.replace("text", F.lit(C.HELD), F.lit(" "))).alias("restored"))


MAX = 480
WINDOW = int(MAX / C.TOKENS_PER_WORD)
# sentences at capitals, too long ones as merged clauses, too long clauses as word windows, then packed
SQL_CHUNKS = f"""
WITH RECURSIVE sent AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (
    SELECT doc_id, list_filter(list_transform(string_split({SQL_MARKED}, '{C.CUT}'), lambda s: {S.strip('s')}), lambda s: s <> '') AS ss FROM documents WHERE {S.est_tokens()} > {MAX})),
cl AS (SELECT doc_id, i, list_filter(list_transform(string_split({sql_marked_clauses('s')}, '{C.CUT}'), lambda x: {S.strip('x')}), lambda x: x <> '') AS cs FROM sent WHERE {S.est_tokens('s')} > {MAX}),
cu AS (SELECT doc_id, i, unnest(cs) AS c, generate_subscripts(cs, 1) AS k FROM cl),
cg AS (SELECT *, sum(CASE WHEN k = 1 OR {S.word_count('c')} >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, i ORDER BY k) AS g FROM cu),
cm AS (SELECT doc_id, i, g, string_agg(c, ' ' ORDER BY k) AS c FROM cg GROUP BY doc_id, i, g),
pc AS (
  SELECT doc_id, i, 0 AS g, 0 AS j, s AS piece FROM sent WHERE {S.est_tokens('s')} <= {MAX}
  UNION ALL SELECT doc_id, i, g, 0, c FROM cm WHERE {S.est_tokens('c')} <= {MAX}
  UNION ALL SELECT doc_id, i, g, j, array_to_string(list_slice(w, j * {WINDOW} + 1, j * {WINDOW} + {WINDOW}), ' ') FROM (
    SELECT doc_id, i, g, w, unnest(range(0, CAST(ceil(len(w) / {WINDOW}) AS BIGINT))) AS j FROM (SELECT *, {S.words('c')} AS w FROM cm WHERE {S.est_tokens('c')} > {MAX}))),
pieces AS (SELECT doc_id, piece, {S.est_tokens('piece')} AS cost, row_number() OVER (PARTITION BY doc_id ORDER BY i, g, j) AS n FROM pc),
walk AS (
  SELECT doc_id, n, cost AS load, 1::BIGINT AS chunk FROM pieces WHERE n = 1
  UNION ALL
  SELECT p.doc_id, p.n, CASE WHEN w.load + p.cost > {MAX} THEN p.cost ELSE w.load + p.cost END, CASE WHEN w.load + p.cost > {MAX} THEN w.chunk + 1 ELSE w.chunk END
  FROM walk w JOIN pieces p ON p.doc_id = w.doc_id AND p.n = w.n + 1)
SELECT doc_id, chunk AS chunk_no, string_agg(piece, ' ' ORDER BY n) AS chunk FROM walk JOIN pieces USING (doc_id, n) GROUP BY doc_id, chunk
UNION ALL SELECT doc_id, 1, {S.strip()} FROM documents WHERE {S.est_tokens()} <= {MAX} AND {S.strip()} <> ''"""


@query("chunk_greedy", SQL_CHUNKS)
def chunk_greedy(spark, sf):
    made = C.chunk_greedy(F.col("text"), MAX)
    return docs(spark, sf).select("doc_id", F.posexplode(made).alias("i", "chunk")).select(
        "doc_id", (F.col("i") + 1).cast("long").alias("chunk_no"), "chunk")


@query("chunk_joined", f"""
WITH RECURSIVE sent AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS n FROM (SELECT doc_id, {S.sentences()} AS ss FROM documents)),
walk AS (
  SELECT doc_id, n, length(s) AS load, 1::BIGINT AS chunk FROM sent WHERE n = 1
  UNION ALL
  SELECT p.doc_id, p.n, CASE WHEN (w.load + 1 + length(p.s)) // 4 > {MAX} THEN length(p.s) ELSE w.load + 1 + length(p.s) END, CASE WHEN (w.load + 1 + length(p.s)) // 4 > {MAX} THEN w.chunk + 1 ELSE w.chunk END
  FROM walk w JOIN sent p ON p.doc_id = w.doc_id AND p.n = w.n + 1),
j AS (SELECT doc_id, chunk, string_agg(s, ' ' ORDER BY n) AS text FROM walk JOIN sent USING (doc_id, n) GROUP BY doc_id, chunk)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk) AS BIGINT) AS chunk_no, text AS chunk FROM j WHERE length(text) // 4 >= 20""")
def chunk_joined(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(C.chunk_joined(F.col("text"), MAX)).alias("i", "chunk")).select(
        "doc_id", (F.col("i") + 1).cast("long").alias("chunk_no"), "chunk")


# chunks = sentences of a document; one too long or too short sends it back whole
@query("validate_chunks", f"""
WITH c AS (SELECT doc_id, text, {S.sentences()} AS cs FROM documents)
SELECT doc_id, len(list_filter(cs, lambda s: NOT ({S.est_tokens('s')} <= 60 AND length({S.strip('s')}) >= 10))) = 0 AS valid,
       CAST(CASE WHEN len(list_filter(cs, lambda s: NOT ({S.est_tokens('s')} <= 60 AND length({S.strip('s')}) >= 10))) = 0 THEN len(cs) ELSE 1 END AS BIGINT) AS chunks FROM c""")
def validate_chunks(spark, sf):
    rows = docs(spark, sf).select("doc_id", "text", C.sentences_at_marks(F.col("text")).alias("cs"))
    return rows.select("doc_id", C.valid_chunks(F.col("cs"), 60).alias("valid"),
                       F.size(C.chunks_or_whole(F.col("text"), F.col("cs"), 60)).cast("long").alias("chunks"))


@query("truncate_tokens", f"""
WITH sent AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS n FROM (SELECT doc_id, {S.sentences()} AS ss FROM documents)),
run AS (SELECT *, sum({S.est_tokens('s')}) OVER (PARTITION BY doc_id ORDER BY n) AS total FROM sent),
kept AS (SELECT doc_id, string_agg(s, '. ' ORDER BY n) AS text FROM run WHERE total <= {MAX} - 10 GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.text, '') || '.' AS text FROM documents d LEFT JOIN kept k USING (doc_id)""")
def truncate_tokens(spark, sf):
    return docs(spark, sf).select("doc_id", C.truncate_tokens(F.col("text"), MAX).alias("text"))


@query("chunk_ids", """
SELECT CAST(conv_id AS VARCHAR) || '_c' || CAST(turn AS VARCHAR) AS chunk_id, CAST(conv_id AS VARCHAR) AS document FROM conversations""")
def chunk_ids(spark, sf):
    made = table(spark, sf, "conversations").select(C.chunk_id(F.col("conv_id"), F.col("turn")).alias("chunk_id"))
    return made.withColumn("document", document_of_chunk(F.col("chunk_id")))


@query("chunk_words", f"""
WITH w AS (SELECT doc_id, string_split_regex(text, {quoted(P.WS_RUN)}) AS w FROM documents),
c AS (SELECT *, greatest(len(w) // 600 + CASE WHEN len(w) % 600 >= 500 THEN 1 ELSE 0 END, 1) AS n FROM w),
i AS (SELECT *, unnest(range(1, n + 1)) AS i FROM c)
SELECT doc_id, i AS chunk_no, array_to_string(list_slice(w, (i - 1) * 600 + 1, CASE WHEN i = n THEN len(w) ELSE i * 600 END), ' ') AS chunk FROM i""")
def chunk_words(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(C.chunk_words(F.col("text"))).alias("i", "chunk")).select(
        "doc_id", (F.col("i") + 1).cast("long").alias("chunk_no"), "chunk")


_NOT_WORD = r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}]"


def _sql_phrases(v):
    low = f"lower({v})"
    parts = S.words(f"regexp_replace({low}, {quoted(_NOT_WORD)}, ' ', 'g')")
    return (f"list_concat(list_concat(list_concat([{low}], list_filter({parts}, lambda w: length(w) > 2 AND NOT regexp_matches(w, '^[0-9]+$'))), "
            f"CASE WHEN len({parts}) > 1 THEN [array_to_string({parts}, ' ')] ELSE [] END), list_concat(CASE WHEN contains({low}, 'instagram') THEN ['instagram', 'ig'] ELSE [] END, "
            f"CASE WHEN contains({low}, '$') THEN regexp_extract_all({low}, '[0-9]+') ELSE [] END))")


# name -> values of the field; the last one is no label and must be ignored
_VALUES = {
    "client": "[source || ' License']", "brand": "['Public Works!']", "fee": "['$' || CAST(n_chars % 10 AS VARCHAR)]",
    "deliverables": "['Instagram ' || lang, 'zzz']", "territory": "['']", "unlisted": "['the']",
}


def field_values():
    said = lambda *words: F.array(*[F.lit(w) for w in words])
    return {
        "client": F.array(F.concat("source", F.lit(" License"))), "brand": said("Public Works!"),
        "fee": F.array(F.concat(F.lit("$"), (F.col("n_chars") % 10).cast("string"))),
        "deliverables": F.array(F.concat(F.lit("Instagram "), F.col("lang")), F.lit("zzz")),
        "territory": said(""), "unlisted": said("the"),
    }


@query("label_by_field_match", "WITH v AS (SELECT doc_id, lower(text) AS low, unnest([" + ", ".join(
    f"struct_pack(name := '{n}', vals := {sql})" for n, sql in _VALUES.items() if n != "unlisted") + f"""]) AS f, lang, source, n_chars FROM documents),
hit AS (SELECT DISTINCT doc_id, name FROM (SELECT doc_id, f.name AS name, low, unnest(list_filter(f.vals, lambda x: x <> '')) AS val FROM v) t
        WHERE len(list_filter({_sql_phrases('val')}, lambda p: contains(low, p))) > 0)
SELECT d.doc_id, coalesce(string_agg(name, '|' ORDER BY name), '') AS labels FROM documents d LEFT JOIN hit USING (doc_id) GROUP BY d.doc_id""")
def label_by_field_match(spark, sf):
    values = field_values()
    fields = F.map_from_arrays(F.array(*[F.lit(n) for n in values]), F.array(*values.values()))
    return docs(spark, sf).select("doc_id", F.array_join(L.label_by_field_match(F.col("text"), fields), "|").alias("labels"))


# patterns fitted to the driver documents
_SUB = (("license", (r"licen[sc]e", r"copyright")), ("contact", (r"@\w+", r"\(\d{3}\)")), ("list", (r"\|", r"\d+\s*x")),
        ("english", (r"\bthe\b", r"\band\b")), ("german", (r"\bder\b", r"\bdie\b")))


def sql_edges(pattern):
    """A whole word for RE2: an edge of Unicode word characters on both sides."""
    if pattern.startswith(r"\b") and pattern.endswith(r"\b"):
        edge = r"[^\p{L}\p{N}_]"
        return f"(?:^|{edge}){pattern[2:-2]}(?:$|{edge})"
    return pattern


def sql_pattern_labels(text, rules):
    return "array_to_string(list_filter([" + ", ".join(
        "CASE WHEN " + " OR ".join(f"regexp_matches(lower({text}), {quoted(sql_edges(p))})" for p in ps) + f" THEN '{n}' END" for n, ps in rules
    ) + "], lambda x: x IS NOT NULL), '|')"


@query("sub_labels", f"SELECT doc_id, {sql_pattern_labels('text', _SUB)} AS labels FROM documents")
def sub_labels(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(L.labels_by_patterns(F.col("text"), _SUB), "|").alias("labels"))


# part names as content, the last rule is fitted to them
_CONTENT = L.CONTENT_PATTERNS + (("small_things", (r"small\s+ring", r"tiny")), ("widgets", (r"widget",)))


@query("content_labels", f"""
SELECT p_partkey, {sql_pattern_labels("p_name || ' in an ' || p_type || ' clip'", _CONTENT)} AS labels FROM part""")
def content_labels(spark, sf):
    text = F.concat("p_name", F.lit(" in an "), "p_type", F.lit(" clip"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(L.labels_by_patterns(text, _CONTENT), "|").alias("labels"))


_POOL = ("photo", "video", "lifestyle", "brand_type", "content_type", "duration_weeks", "usage_duration", "product_focused")
_SQL_LEVEL = "CASE WHEN doc_id % 4 = 0 THEN 'minimal' WHEN doc_id % 4 = 1 THEN 'moderate' WHEN doc_id % 4 = 2 THEN 'complex' ELSE 'comprehensive' END"


@query("label_padding", f"""
WITH {S.DOC_LABELS}, l AS (SELECT doc_id, list_distinct(labels) AS own, {_SQL_LEVEL} AS level FROM doc_labels),
b AS (SELECT *, CASE level WHEN 'minimal' THEN 1 WHEN 'moderate' THEN 3 WHEN 'complex' THEN 5 ELSE 7 END AS lo, CASE level WHEN 'minimal' THEN 3 WHEN 'moderate' THEN 6 WHEN 'complex' THEN 9 ELSE 12 END AS hi FROM l),
c AS (SELECT doc_id, lo, hi, len(own) AS n, unnest(own) AS x, 0 AS spare FROM b UNION ALL SELECT doc_id, lo, hi, len(own), unnest(list_filter({sql_list(_POOL)}, lambda p: NOT list_contains(own, p))), 1 FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, spare ORDER BY md5(CAST(doc_id AS VARCHAR) || '|' || x)) AS k FROM c)
SELECT doc_id, string_agg(x, '|' ORDER BY x) AS labels FROM r WHERE CASE WHEN spare = 0 THEN k <= hi ELSE k <= lo - n END GROUP BY doc_id""")
def label_padding(spark, sf):
    rest = F.col("doc_id") % 4
    level = F.when(rest == 0, "minimal").when(rest == 1, "moderate").when(rest == 2, "complex").otherwise("comprehensive")
    padded = L.pad_labels(F.col("labels"), level, _POOL, F.col("doc_id"))
    return doc_labels(spark, sf).select("doc_id", F.array_join(padded, "|").alias("labels"))


@query("multi_label_merge", f"""
WITH {S.DOC_LABELS}, r AS (SELECT d.doc_id, d.lang, trim(string_split(d.text, '. ')[1]) AS head, l.labels, row_number() OVER (PARTITION BY d.lang ORDER BY md5('42|' || CAST(d.doc_id AS VARCHAR)), d.doc_id) AS k FROM documents d JOIN doc_labels l USING (doc_id)),
g AS (SELECT *, (k - 1) // 3 AS part FROM r),
t AS (SELECT lang, part, string_agg(head, '. ' ORDER BY k) || '.' AS text, string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY k) AS source_ids, count(*) AS n FROM g GROUP BY lang, part),
l AS (SELECT lang, part, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM (SELECT lang, part, unnest(labels) AS label FROM g) GROUP BY lang, part)
SELECT lang, part, text, labels, source_ids FROM t JOIN l USING (lang, part) WHERE n > 1""")
def multi_label_merge(spark, sf):
    made = PH.multi_label_merge(doc_labels(spark, sf, "text", "lang"), "doc_id", "text", "labels", "lang")
    return made.select("lang", "part", "text", F.array_join("labels", "|").alias("labels"),
                       F.array_join(F.transform("source_ids", lambda x: x.cast("string")), "|").alias("source_ids"))


@query("label_count_range", f"""
WITH {S.DOC_LABELS} SELECT doc_id, CASE WHEN len(labels) <= 2 THEN '1-2' WHEN len(labels) <= 4 THEN '3-4' WHEN len(labels) <= 6 THEN '5-6' WHEN len(labels) <= 8 THEN '7-8' ELSE '9+' END AS bucket FROM doc_labels""")
def label_count_range(spark, sf):
    return doc_labels(spark, sf).select("doc_id", L.label_count_range(F.size("labels")).alias("bucket"))


@query("sample_type", f"""
WITH {S.DOC_LABELS} SELECT doc_id, CASE WHEN list_contains(labels, 'toxic') THEN 'distractor' WHEN len(labels) >= 4 THEN 'multi_label' ELSE 'original' END AS sample_type FROM doc_labels""")
def sample_type(spark, sf):
    return doc_labels(spark, sf).select("doc_id", L.sample_type(F.array_contains("labels", "toxic"), F.size("labels") >= 4).alias("sample_type"))


@query("labels_from_fields", """
SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(text, '@') THEN 'client' END, CASE WHEN source <> '' THEN 'deliverables' END, CASE WHEN quality = 1 THEN 'fee' END, CASE WHEN lang <> 'en' THEN 'territory' END], lambda x: x IS NOT NULL), '|') AS labels
FROM documents LEFT JOIN labels USING (doc_id)""")
def labels_from_fields(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    fields = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("contact", "source", "score", "region", "other")]),
        F.array(F.when(F.col("text").contains("@"), "@"), F.col("source"), F.when(F.col("quality") == 1, "1"),
                F.when(F.col("lang") != "en", F.col("lang")), F.lit("x")))
    names = {"contact": "client", "source": "deliverables", "score": "fee", "region": "territory"}
    return rows.select("doc_id", F.array_join(L.labels_from_fields(fields, names), "|").alias("labels"))


# lexicons fitted to the driver documents
_YES, _NO = ("the ", "with ", "license", "this ", "public"), ("der ", "que ", "les ", "und ")
_HARD = ("license", "general", "version", "|", "released")
_INDUSTRIES = (("english", ("the ", "and ", "that ")), ("german", ("der ", "und ", "sich ")), ("french", (" les ", " une ", "avec ")), ("spanish", ("los ", " del ", " una ")))


@query("classify_doc_type", f"""
SELECT doc_id, CASE WHEN {sql_terms('lower(text)', _YES)} > {sql_terms('lower(text)', _NO)} AND {sql_terms('lower(text)', _YES)} >= 2 THEN 'INFLUENCER_AGREEMENT' ELSE 'NOT_INFLUENCER' END AS document_type FROM documents""")
def classify_doc_type(spark, sf):
    return docs(spark, sf).select("doc_id", K.classify_doc_type(F.col("text"), _YES, _NO).alias("document_type"))


_ITEMS = f"(len(regexp_extract_all(text, {quoted(r'(?m)^\s*[•\-\*]\s+')})) + len(regexp_extract_all(text, {quoted(r'(?m)^\s*\d+\.\s+')})))"


@query("classify_complexity", f"""
WITH s AS (SELECT doc_id, {S.word_count()} AS n, {sql_terms('lower(text)', _HARD)} + {_ITEMS} * 0.5 AS score FROM documents)
SELECT doc_id, CASE WHEN n > 400 AND score >= 3 THEN 'complex' WHEN n > 200 AND score >= 1 THEN 'medium' ELSE 'simple' END AS complexity FROM s""")
def classify_complexity(spark, sf):
    return docs(spark, sf).select("doc_id", K.classify_complexity(F.col("text"), _HARD).alias("complexity"))


def _sql_argmax(scores, default, at_least=1):
    top = "greatest(" + ", ".join(s for _, s in scores) + ")"
    cases = " ".join(f"WHEN {s} = {top} THEN '{n}'" for n, s in scores)
    return f"CASE WHEN {top} < {at_least} THEN '{default}' {cases} END"


_IND_SCORES = [(n, sql_terms("low", t)) for n, t in _INDUSTRIES]


@query("classify_industry", f"SELECT doc_id, {_sql_argmax(_IND_SCORES, 'other')} AS industry FROM (SELECT doc_id, lower(text) AS low FROM documents)")
def classify_industry(spark, sf):
    return docs(spark, sf).select("doc_id", K.classify_industry(F.col("text"), _INDUSTRIES).alias("industry"))


_OCC = [(n, "(" + " + ".join(f"CAST((length(low) - length(replace(low, {quoted(t)}, ''))) / {len(t)} AS BIGINT)" for t in ts) + ")") for n, ts in _INDUSTRIES]


@query("classify_variants", f"""
WITH x AS (SELECT doc_id, text, lower(text) AS low, {S.word_count()} AS n FROM documents),
f AS (SELECT *, (CASE WHEN length(text) > 10000 THEN 2 WHEN length(text) > 5000 THEN 1 ELSE 0 END) + {sql_terms('low', _HARD)} + CASE WHEN {sql_terms('low', ('the', 'of', 'and', 'fee'))} >= 3 THEN 1 ELSE 0 END
  + CASE WHEN length(text) - length(replace(replace(text, '.', ''), chr(10), '')) > 100 THEN 1 ELSE 0 END AS score FROM x)
SELECT doc_id, CASE WHEN n < 500 THEN 'simple' WHEN n < 1500 THEN 'medium' ELSE 'complex' END AS by_length,
  CASE {' '.join(f"WHEN {s} >= 2 THEN '{n}'" for n, s in _IND_SCORES)} ELSE 'general' END AS first_industry,
  {_sql_argmax(_OCC, 'general')} AS by_occurrence, greatest({', '.join(s for _, s in _OCC)}) < 3 AS low_confidence,
  CASE WHEN score >= 4 THEN 'complex' WHEN score >= 2 THEN 'medium' ELSE 'simple' END AS four_factor FROM f""")
def classify_variants(spark, sf):
    text = F.col("text")
    found = K.industry_by_occurrence(text, _INDUSTRIES)
    return docs(spark, sf).select(
        "doc_id", K.length_class(text).alias("by_length"), K.first_industry(text, _INDUSTRIES).alias("first_industry"), found.alias("f"),
        K.four_factor_complexity(text, _HARD, ("the", "of", "and", "fee")).alias("four_factor"),
    ).select("doc_id", "by_length", "first_industry", F.col("f.industry").alias("by_occurrence"), "f.low_confidence", "four_factor")


_FORMAL, _CASUAL = ("the ", "license", "this ", "version", "of "), ("the", "ing ", "ou", "hey")
SQL_SENT = f"""
sent AS (SELECT doc_id, text, list_transform(list_filter(string_split_regex(text, '[.!?]+'), lambda s: {S.strip('s')} <> ''), lambda s: {S.word_count('s')}) AS ns FROM documents),
meas AS (SELECT doc_id, text, len(ns) AS sentences, coalesce(list_sum(ns) / nullif(len(ns), 0), 0)::DOUBLE AS mean_len, {S.word_count()} AS n FROM sent)"""


@query("complexity_score3", f"""
WITH {SQL_SENT}, s AS (SELECT doc_id, sentences,
  CASE WHEN mean_len > 30 THEN 3 WHEN mean_len > 20 THEN 2 ELSE 1 END
  + CASE WHEN (length(text) - length(replace(replace(text, ',', ''), ';', ''))) / nullif(sentences, 0) > 0.3 THEN 3 WHEN (length(text) - length(replace(replace(text, ',', ''), ';', ''))) / nullif(sentences, 0) > 0.15 THEN 2 ELSE 1 END
  + CASE WHEN {sql_terms('lower(text)', _FORMAL)} * 1000.0 / n > 5 THEN 3 WHEN {sql_terms('lower(text)', _FORMAL)} * 1000.0 / n > 2 THEN 2 ELSE 1 END AS score FROM meas)
SELECT doc_id, CASE WHEN sentences = 0 THEN 'simple' WHEN score >= 8 THEN 'complex' WHEN score >= 5 THEN 'medium' ELSE 'simple' END AS complexity FROM s""")
def complexity_score3(spark, sf):
    return docs(spark, sf).select("doc_id", K.complexity_score3(F.col("text"), _FORMAL).alias("complexity"))


_BULLETS = " + ".join(f"len(regexp_extract_all(text, {quoted(p)}))" for p in P.BULLET_LINES)


# every third text gets a list in front
@query("style_detect", f"""
WITH x AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('- one', chr(10), '* two', chr(10), '3. three', chr(10)) ELSE '' END || text AS text FROM documents)
SELECT doc_id, CASE WHEN {_BULLETS} > 2 THEN 'bullets' WHEN {sql_terms('lower(text)', _FORMAL)} > {sql_terms('lower(text)', _CASUAL)} THEN 'formal' ELSE 'casual' END AS style,
  CASE WHEN contains(text, '•') OR length(text) - length(replace(text, '-', '')) > 3 THEN 'bullet_points' WHEN {sql_terms('lower(text)', ('hey', 'mate', 'reckon', 'budget', 'around'))} > 0 THEN 'casual' ELSE 'formal' END AS simple_style,
  CASE WHEN contains(lower(text), 'license') THEN 'legal' WHEN contains(lower(text), 'der ') THEN 'german' ELSE 'plain' END AS keyword_style FROM x""")
def style_detect(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.concat(
        F.when(F.col("doc_id") % 3 == 0, "- one\n* two\n3. three\n").otherwise(""), F.col("text")).alias("text"))
    text = F.col("text")
    return rows.select("doc_id", K.style_detect(text, _FORMAL, _CASUAL).alias("style"), K.text_style(text).alias("simple_style"),
                       K.keyword_style(text, (("legal", ("license",)), ("german", ("der ",))), "plain").alias("keyword_style"))


@query("style_profile", f"""
WITH {SQL_SENT}, c AS (SELECT *, {sql_terms('lower(text)', _FORMAL)} AS f, {sql_terms('lower(text)', _CASUAL)} AS c, len(regexp_extract_all(text, {quoted(P.PASSIVE)})) AS passive FROM meas)
SELECT doc_id, f::BIGINT AS formal_count, c::BIGINT AS casual_count, round(f / (f + c + 1), 10) AS formal_ratio, CASE WHEN f > c THEN 'formal' ELSE 'casual' END AS dominant_tone,
  round(mean_len, 10) AS mean_sentence_length, round(f / (f + c + 1) * 0.5 + least(mean_len / 30, 1) * 0.3 + least(passive / 10, 1) * 0.2, 10)::DOUBLE AS formality,
  round(len(regexp_extract_all(text, '[,;]')) / greatest(n, 1), 10) AS clause_density FROM c""")
def style_profile(spark, sf):
    rows = docs(spark, sf).select("doc_id", K.style_profile(F.col("text"), _FORMAL, _CASUAL).alias("p")).select("doc_id", "p.*")
    for name in ("formal_ratio", "mean_sentence_length", "formality", "clause_density"):
        rows = rows.withColumn(name, F.round(name, 10))
    return rows


@query("sentence_structures", f"""
WITH h AS (SELECT doc_id, list_filter(list_transform(list_slice(string_split_regex(text, '[.!?]+'), 1, 20), lambda s: {S.strip('s')}), lambda s: length(s) > 10) AS hs FROM documents),
u AS (SELECT doc_id, unnest(hs) AS s, generate_subscripts(hs, 1) AS i FROM h)
SELECT doc_id, CAST(i AS BIGINT) AS place, {S.word_count('s')} AS length, contains(s, ',') AS has_clause,
  lower(regexp_extract(s, {quoted(P.WORD_RUN)})) IN ({', '.join(quoted(w) for w in P.SUBJECT_WORDS)}) OR regexp_matches(s, '^\\p{{Lu}}') AS starts_with_subject, {sql_terms('lower(s)', _FORMAL)} > 0 AS legal FROM u""")
def sentence_structures(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.posexplode(K.sentence_structures(F.col("text"), 20, _FORMAL)).alias("i", "s"))
    return rows.select("doc_id", (F.col("i") + 1).cast("long").alias("place"), "s.*")


@query("key_phrases", """
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '(?:^|[^\\p{L}\\p{N}_])([a-z]+)(?:$|[^\\p{L}\\p{N}_])') AS x, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS toks FROM documents),
l AS (SELECT doc_id, list_filter(toks, lambda t: regexp_matches(t, '^[a-z]+$')) AS w FROM w),
g AS (SELECT doc_id, 2 AS size, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(list_slice(w, i, i + 1), ' '))) AS phrase FROM l
      UNION ALL SELECT doc_id, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) FROM l),
c AS (SELECT doc_id, size, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, size ORDER BY n DESC, phrase) AS rank FROM c)
SELECT doc_id, size::BIGINT AS size, phrase, n, rank FROM r WHERE rank <= CASE size WHEN 2 THEN 20 ELSE 10 END""")
def key_phrases(spark, sf):
    return PH.key_phrases(docs(spark, sf), "doc_id", "text")


@query("keywords", f"""
WITH w AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda t: regexp_matches(t, '^[a-z]{{4,}}$'))) AS word FROM documents),
c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE word NOT IN ({', '.join(quoted(x) for x in P.KEYWORD_STOPS)}) GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rank FROM c)
SELECT doc_id, word, n, rank FROM r WHERE rank <= 15""")
def keywords(spark, sf):
    return PH.keywords(docs(spark, sf), "doc_id", "text")


_COH = dict(strong=("license",), moderate=("this ", "with "), platform=("public", "version"), strong_neg=("der ", "les "), moderate_neg=("$$$", "|"))


@query("coherence_rules", f"""
WITH s AS (SELECT doc_id, text, 2 * {sql_terms('lower(text)', _COH['strong'])} + {sql_terms('lower(text)', _COH['moderate'])} + {sql_terms('lower(text)', _COH['platform'])} AS p,
  3 * {sql_terms('lower(text)', _COH['strong_neg'])} + {sql_terms('lower(text)', _COH['moderate_neg'])} AS m, {S.word_count()} AS n FROM documents)
SELECT doc_id, round(CASE WHEN {S.strip()} = '' THEN 0 ELSE greatest(0, least(1, (CASE WHEN p >= 3 AND m = 0 THEN 0.75 WHEN p >= 2 AND m <= 1 THEN 0.65 WHEN p >= 1 AND m <= 2 THEN 0.55 WHEN m >= 3 THEN 0.2 WHEN m >= 1 THEN 0.4 ELSE 0.5 END)::DOUBLE
  * CASE WHEN n < 50 THEN 0.8::DOUBLE WHEN n > 300 THEN 1.1 ELSE 1.0 END)) END, 6)::DOUBLE AS score FROM s""")
def coherence_rules(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(K.coherence_rules(F.col("text"), **_COH), 6).alias("score"))


# class 0 is the good bank, class 1 the bad one
@query("coherence_cosine", """
WITH s AS (SELECT a.vec_id, b.label, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM embeddings a, embeddings b WHERE b.label IN (0, 1)),
g AS (SELECT vec_id, max(sim) FILTER (label = 0) AS mg, avg(sim) FILTER (label = 0) AS ag, max(sim) FILTER (label = 1) AS mb, avg(sim) FILTER (label = 1) AS ab FROM s GROUP BY vec_id)
SELECT vec_id, round(greatest(0, least(1, 0.4 * mg + 0.3 * ag - (0.2 * mb + 0.1 * ab) + 0.3)), 6)::DOUBLE AS score, greatest(0, least(1, 0.4 * mg + 0.3 * ag - (0.2 * mb + 0.1 * ab) + 0.3)) >= 0.6 AS coherent FROM g""")
def coherence_cosine(spark, sf):
    rows = vecs(spark, sf)
    good, bad = rows.where("label = 0"), rows.where("label = 1")

    def bank(part, name):
        best = V.knn(rows, part, 1).select(F.col("query").alias("id"), F.col("sim").alias(f"max_{name}"))
        return best.join(V.mean_similarity_to(rows, part, f"mean_{name}"), "id")

    scored = rows.select("id").join(bank(good, "good"), "id").join(bank(bad, "bad"), "id")
    score = K.coherence_from_similarity(F.col("max_good"), F.col("mean_good"), F.col("max_bad"), F.col("mean_bad"))
    return scored.select(F.col("id").alias("vec_id"), F.round(score, 6).alias("score"), (score >= 0.6).alias("coherent"))


_CASUAL_WORDS = (("the", "a"), ("of the", "from a"), ("with", ""))
_FORMAL_WORDS = (("die", "jene"), ("les", "ces"))
_CASUAL_RULES = tuple((rf"(?i)\b{a}\b", b) for a, b in _CASUAL_WORDS)
_FORMAL_RULES = tuple((rf"(?i)\b{a}\b", b) for a, b in _FORMAL_WORDS)
_SYN = (("that", "which"), ("this", "such"), ("del", "de"))


# RE2 has no Unicode word boundary: the neighbours are matched and put back, twice because matches may share one
_EDGE = r"[^\p{L}\p{N}_]"


def sql_words(text, rules):
    for word, other in rules:
        for _ in range(2):
            text = f"regexp_replace({text}, {quoted(f'(?i)(^|{_EDGE}){word}($|{_EDGE})')}, {quoted(chr(92) + '1' + other + chr(92) + '2')}, 'g')"
    return text


def sql_fold(text, rules, flags="'g'"):
    for pattern, other in rules:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(other)}, {flags})"
    return text


@query("style_rewrite", f"""
SELECT doc_id, CASE WHEN lang = 'es' THEN array_to_string(list_transform(list_filter({S.sentences()}, lambda s: {S.word_count('s')} >= 3), lambda s: '• ' || s), chr(10))
  WHEN lang = 'en' THEN {sql_words('text', _CASUAL_WORDS)} ELSE {sql_words('text', _FORMAL_WORDS)} END AS text,
  {sql_words('text', _SYN)} AS swapped,
  trim({sql_fold('text', [(f'(^|{_EDGE})(?:very|quite|really|extremely|absolutely){chr(92)}s+', f'{chr(92)}1')] * 2 + [(f'(^|{_EDGE})(?:and|or){chr(92)}s+', f'{chr(92)}1, ')] * 2 + [(chr(92) + 's+', ' ')])}) AS shortened FROM documents""")
def style_rewrite(spark, sf):
    text = F.col("text")
    style = F.when(F.col("lang") == "es", "bullets").when(F.col("lang") == "en", "casual").otherwise("formal")
    return docs(spark, sf).select(
        "doc_id", RW.rewrite(text, style, _CASUAL_RULES, _FORMAL_RULES).alias("text"), RW.replace_words(text, _SYN).alias("swapped"),
        F.trim(RW.apply_patterns(text, RW.FILLERS)).alias("shortened"))


@query("fragments", f"""
WITH u AS (SELECT doc_id, unnest({S.sentences()}) AS s FROM documents),
k AS (SELECT doc_id, {sql_fold('s', P.FRAGMENT_MASKS)} AS fragment FROM u WHERE {S.word_count('s')} >= 5 AND NOT ({' OR '.join(f"regexp_matches(s, {quoted(p.replace(chr(92) + 'b[A-Z]', '(?:^|' + _EDGE + ')[A-Z]').replace('[a-z]+' + chr(92) + 'b', '[a-z]+(?:$|' + _EDGE + ')'))})" for p in P.FRAGMENT_SKIPS)}))
SELECT doc_id, fragment FROM k WHERE {S.word_count('fragment')} >= 3""")
def fragments(spark, sf):
    return docs(spark, sf).select("doc_id", F.explode(K.fragments(F.col("text"))).alias("fragment"))


@query("mask_pattern", f"SELECT doc_id, {sql_mask()} AS pattern FROM documents")
def mask_pattern(spark, sf):
    return docs(spark, sf).select("doc_id", mask(F.col("text")).alias("pattern"))


def sql_draw(purpose):
    return f"CAST('0x' || substr(md5('42|{purpose}|' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


_NOTE = "\n\nAdditional notes: TBC on exact dates"


@query("augment_text", f"""
WITH p AS (SELECT doc_id, string_split(text, '. ') AS ss FROM documents), u AS (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM p),
r AS (SELECT doc_id, string_agg(s, '. ' ORDER BY md5(CAST(doc_id AS VARCHAR) || '|' || s), i) AS reordered FROM u GROUP BY doc_id),
m AS (SELECT doc_id, replace(replace(text, 'the', 'a'), 'and', 'plus') AS swapped, CASE WHEN {sql_draw('typo')} < 0.2 THEN replace(replace(text, 'the', 'teh'), 'der', 'dre') ELSE text END || CASE WHEN {sql_draw('note')} < 0.3 THEN concat(chr(10), chr(10), 'Additional notes: TBC on exact dates') ELSE '' END AS messy FROM documents)
SELECT doc_id, reordered, swapped, CASE WHEN {sql_draw('breaks')} < 0.15 THEN replace(messy, '.', '.' || chr(10)) ELSE messy END AS messy FROM m JOIN r USING (doc_id)""")
def augment_text(spark, sf):
    made = RW.augment(F.col("text"), F.col("doc_id"), (("the", "a"), ("and", "plus")), (("the", "teh"), ("der", "dre")), _NOTE)
    return docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in made.items()])


@query("token_dropout", f"""
WITH t AS (SELECT doc_id, text, regexp_extract_all(text, {quoted(P.TOKEN + '|' + _NOT_WORD)}) AS toks FROM documents),
u AS (SELECT doc_id, unnest(toks) AS t, generate_subscripts(toks, 1) AS i, greatest(1, CAST(floor(len(toks) * 0.125) AS BIGINT)) AS drop_n FROM t WHERE len(toks) > 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5(CAST(doc_id AS VARCHAR) || '|' || CAST(i - 1 AS VARCHAR)), i) AS k FROM u),
m AS (SELECT doc_id, i, CASE WHEN k <= drop_n THEN '[MASK]' ELSE t END AS t FROM r),
g AS (SELECT doc_id, i, CASE WHEN regexp_matches(t, '^{P.W}') AND regexp_matches(lag(t) OVER (PARTITION BY doc_id ORDER BY i), '^{P.W}') THEN ' ' ELSE '' END || t AS t FROM m)
SELECT doc_id, string_agg(t, '' ORDER BY i) AS text FROM g GROUP BY doc_id UNION ALL SELECT doc_id, text FROM t WHERE len(toks) <= 2""")
def token_dropout(spark, sf):
    return docs(spark, sf).select("doc_id", RW.token_dropout(F.col("text"), F.col("doc_id")).alias("text"))


@query("completeness", """
SELECT doc_id, CASE WHEN m = 0 THEN 'complete' WHEN m <= 2 THEN 'partial' ELSE 'minimal' END AS completeness FROM (
  SELECT doc_id, (CASE WHEN contains(text, '@') THEN 0 ELSE 1 END) + (CASE WHEN quality IS NULL THEN 1 ELSE 0 END) + (CASE WHEN toxic = 1 THEN 1 ELSE 0 END) + (CASE WHEN lang = 'en' THEN 0 ELSE 1 END) AS m FROM documents LEFT JOIN labels USING (doc_id))""")
def completeness(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    fields = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("influencer", "brand", "fee", "deliverables")]),
        F.array(F.when(F.col("text").contains("@"), "@"), F.col("quality").cast("string"),
                F.when(F.col("toxic") == 1, "TBC").otherwise("ok"), F.when(F.col("lang") == "en", "en").otherwise("")))
    return rows.select("doc_id", K.completeness(fields).alias("completeness"))


@query("confidence_score", f"""
SELECT doc_id, round(greatest(0.3, least(0.95, CASE WHEN n_chars > 4000 THEN 0.58 WHEN n_chars > 800 THEN 0.72 ELSE 0.85 END
  + CASE lang WHEN 'en' THEN 0.1 WHEN 'fr' THEN -0.15 ELSE 0 END - CASE WHEN regexp_matches(lower(text), '\\b(?:license|the)\\b') THEN 0.1 ELSE 0 END
  - CASE WHEN contains(text, '$$') OR contains(text, '|') THEN 0.08 ELSE 0 END - CASE WHEN {S.word_count()} < 20 THEN 0.05 ELSE 0 END))::DOUBLE, 6) AS confidence FROM documents""")
def confidence_score(spark, sf):
    level = F.when(F.col("n_chars") > 4000, "complex").when(F.col("n_chars") > 800, "medium").otherwise("simple")
    style = F.when(F.col("lang") == "en", "formal_brief").when(F.col("lang") == "fr", "brief_sms").otherwise("plain")
    made = K.confidence_score(F.col("text"), level, style, ("license", "the"), ("$$", "|"))
    return docs(spark, sf).select("doc_id", F.round(made, 6).alias("confidence"))


_ANCHORS = (("Hunch", ("the ", "that "), ("might",)), ("Wisdom", ("license", "of "), ("public",)), ("Nudge", ("der ", "que "), ("und ",)), ("Spell", ("les ", "and "), ("with ",)))


def _sql_route(s):
    scores = [(n, f"({sql_terms(f'lower({s})', w)} + 2 * {sql_terms(f'lower({s})', m)})") for n, w, m in reversed(_ANCHORS)]
    return _sql_argmax(scores, "Hunch")


@query("route_sentences", f"""
WITH u AS (SELECT doc_id, unnest({S.sentences()}) AS s FROM documents)
SELECT doc_id, class, count(*) AS n FROM (SELECT doc_id, {_sql_route('s')} AS class FROM u WHERE length(s) > 10) GROUP BY doc_id, class""")
def route_sentences(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.explode(C.sentences_at_marks(F.col("text"))).alias("s")).where(F.length("s") > 10)
    return rows.select("doc_id", K.route_class(F.col("s"), _ANCHORS, "Hunch").alias("class")).groupBy("doc_id", "class").agg(F.count("*").alias("n"))


@query("threshold_route", f"""
WITH {SQL_GOLD}, b AS (SELECT query, max(id) FILTER (rank = 1) AS best, max(sim) FILTER (rank = 1) AS s1, max(sim) FILTER (rank = 2) AS s2 FROM combo GROUP BY query)
SELECT query, CASE WHEN s1 < 0.1 OR s1 - s2 < 0.05 OR s1 < 0.25 THEN 'default' ELSE CAST(best AS VARCHAR) END AS class FROM b""")
def threshold_route(spark, sf):
    first, second = F.col("rank") == 1, F.col("rank") == 2
    best = combos(spark, sf).where("rank <= 2").groupBy("query").agg(
        F.max(F.when(first, F.col("id"))).cast("string").alias("best"), F.max(F.when(first, F.col("sim"))).alias("s1"),
        F.max(F.when(second, F.col("sim"))).alias("s2"))
    return best.select("query", K.threshold_class(F.col("best"), F.col("s1"), F.col("s2"), "default", 0.25).alias("class"))


@query("vector_normalise", """
SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 5) AS squared, CAST(len(embedding) AS BIGINT) AS dim, len(embedding) = 64 AS usable,
  round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 6) AS first FROM embeddings""")
def vector_normalise(spark, sf):
    vec = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", F.round(VF.dot(vec, vec), 5).alias("squared"), F.size(vec).cast("long").alias("dim"), VF.is_usable(vec, 64).alias("usable"),
        F.round(VF.normalise(vec)[0], 6).alias("first"))


# each vector against the one with the next id
@query("cosine", """
SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(other, "vec_id").select("vec_id", F.round(VF.cosine(F.col("embedding"), F.col("other")), 6).alias("sim"))


@query("json_fields", """
SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k, coalesce(json_extract_string(props, '$.client.name'), 'unknown') AS client FROM events""")
def json_fields(spark, sf):
    parsed = F.from_json("props", "k long, client struct<name: string>")
    return table(spark, sf, "events").select("event_id", parsed.alias("p")).select(
        "event_id", F.coalesce("p.k", F.lit(0)).cast("long").alias("k"), F.coalesce("p.client.name", F.lit("unknown")).alias("client"))


@query("run_duration", """
WITH r AS (SELECT user_id, min(ts) AS s, CASE WHEN max(event_id) % 2 = 0 THEN max(ts) END AS f FROM events GROUP BY user_id)
SELECT user_id, CAST(secs // 60 AS BIGINT) AS minutes, CAST(secs % 60 AS BIGINT) AS seconds FROM (SELECT user_id, date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', coalesce(f, TIMESTAMP '2024-02-01'))) - date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', s)) AS secs FROM r)""")
def run_duration(spark, sf):
    runs = table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("started"), F.when(F.max("event_id") % 2 == 0, F.max("ts")).alias("finished"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    whole = lambda c: F.date_trunc("second", c).cast("timestamp_ntz")
    secs = F.timestamp_diff("SECOND", whole(F.col("started")), whole(F.coalesce("finished", now)))
    return runs.select("user_id", F.floor(secs / 60).alias("minutes"), F.pmod(secs, F.lit(60)).cast("long").alias("seconds"))
