"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomset.functions import patterns as P
from loomset.functions import rules as R
from loomset.functions import text as T
from loomset.operators import checks as C

from . import sqltext as S
from .registry import query, quoted, small_table, table, texts
from .views import samples

# marks that occur in the driver documents
FITTED_HEADERS = (r"(?m)^The ",)
FITTED_FOOTERS = (r"(?i)licen[sc]e",)


def docs(spark, sf):
    return texts(spark, sf)


@query("clean_text", f"SELECT doc_id, {S.clean_text()} AS text FROM documents")
def clean_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query("clean_text_nfkc", f"SELECT doc_id, {S.clean_text()} AS text FROM documents")
def clean_text_nfkc(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_text(F.col("text"), unicode_form=True).alias("text"))


# a date is put before every text from its id; the phone rules would eat the ten digits after it
@query("protect_restore_dates", f"""
SELECT doc_id, 'on ' || printf('%02d/%02d/20%02d', CAST(doc_id % 12 + 1 AS INT), CAST(doc_id % 28 + 1 AS INT), CAST(doc_id % 30 AS INT))
       || ' call [PHONE] ' || {S.redact_pii()} AS text
FROM documents""")
def protect_restore_dates(spark, sf):
    i = F.col("doc_id")
    date = F.format_string("%02d/%02d/20%02d", i % 12 + 1, i % 28 + 1, i % 30)
    noted = F.concat(F.lit("on "), date, F.lit(" call 555-123-4567 "), F.col("text"))
    return docs(spark, sf).select("doc_id", T.outside_dates(noted, lambda piece: T.redact_pii(piece)).alias("text"))


@query("redact_pii", f"SELECT doc_id, {S.redact_pii()} AS text FROM documents")
def redact_pii(spark, sf):
    return docs(spark, sf).select("doc_id", T.redact_pii(F.col("text")).alias("text"))


def _sql_count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quoted(pattern)}))"


def _sql_counts(text: str, patterns, mark: str) -> str:
    parts = []
    for pattern in patterns:
        parts.append(_sql_count(text, pattern))
        text = f"regexp_replace({text}, {quoted(pattern)}, '{mark}', 'g')"
    return " + ".join(parts)


def _counts(text, patterns, mark: str):
    """Matches of the patterns, each on what those before it left, and that text."""
    found = F.lit(0)
    for pattern in patterns:
        found = found + F.regexp_count(text, F.lit(T.UNI + pattern))
        text = F.regexp_replace(text, T.UNI + pattern, mark)
    return found, text


_QUOTES = "[“”‘’]"


@query("redaction_stats", f"""
SELECT CAST(count(*) AS BIGINT) AS processed,
       CAST(sum({_sql_count('text', P.EMAIL)}) AS BIGINT) AS emails_redacted,
       CAST(sum({_sql_counts(S.redact_email(), P.PHONES, '[PHONE]')}) AS BIGINT) AS phones_redacted,
       CAST(sum({_sql_count(S.redact_pii(), P.SSN)}) AS BIGINT) AS ssns_redacted,
       CAST(sum({_sql_count('text', _QUOTES)}) AS BIGINT) AS quotes_normalized,
       CAST(sum({_sql_counts('text', P.MONEY, '$' + chr(92) + '1')}) AS BIGINT) AS currency_normalized,
       CAST(sum({_sql_count('text', P.WS_RUN + '')}) AS BIGINT) AS whitespace_runs
FROM documents""")
def redaction_stats(spark, sf):
    text = F.col("text")
    phones, left = _counts(T.redact_email(text), P.PHONES, "[PHONE]")
    money, _ = _counts(text, P.MONEY, r"\$$1")
    return docs(spark, sf).agg(
        F.count("*").alias("processed"),
        F.sum(F.regexp_count(text, F.lit(T.UNI + P.EMAIL))).alias("emails_redacted"),
        F.sum(phones).alias("phones_redacted"),
        F.sum(F.regexp_count(left, F.lit(T.UNI + P.SSN))).alias("ssns_redacted"),
        F.sum(F.regexp_count(text, F.lit(_QUOTES))).alias("quotes_normalized"),
        F.sum(money).alias("currency_normalized"),
        F.sum(F.regexp_count(text, F.lit(P.WS_RUN))).alias("whitespace_runs"),
    )


@query("normalize_quotes", f"""
SELECT doc_id, {S.normalize_quotes("'“' || text || '” said ‘x’…'")} AS text FROM documents""")
def normalize_quotes(spark, sf):
    noted = F.concat(F.lit("“"), F.col("text"), F.lit("” said ‘x’…"))
    return docs(spark, sf).select("doc_id", T.normalize_quotes(noted).alias("text"))



@query("normalize_currency", f"""
SELECT o_orderkey, {S.normalize_currency("concat('$ ', format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ' or USD ', CAST(o_orderkey % 1000 AS VARCHAR), ' or ', CAST(o_orderkey % 97 AS VARCHAR), ' dollars')")} AS fee
FROM orders""")
def normalize_currency(spark, sf):
    orders = table(spark, sf, "orders")
    note = F.concat(
        F.lit("$ "), F.format_number(F.floor("o_totalprice"), 0),
        F.lit(" or USD "), (F.col("o_orderkey") % 1000).cast("string"),
        F.lit(" or "), (F.col("o_orderkey") % 97).cast("string"), F.lit(" dollars"),
    )
    return orders.select("o_orderkey", T.normalize_currency(note).alias("fee"))


@query("normalize_whitespace", f"SELECT doc_id, {S.squeeze()} AS text FROM documents")
def normalize_whitespace(spark, sf):
    return docs(spark, sf).select("doc_id", T.normalize_whitespace(F.col("text")).alias("text"))


@query("validate_text", f"SELECT doc_id, {S.is_valid_text()} AS valid FROM documents")
def validate_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.is_valid_text(F.col("text")).alias("valid"))


_PHONE_HIT = " OR ".join(f"regexp_matches(text, {quoted(p)})" for p in P.PHONES)


@query("text_metadata", f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, {S.word_count()} AS word_count,
       CAST(len(regexp_extract_all(text, {quoted(chr(92) + 'n')}))
            + CASE WHEN length(text) > 0 AND right(text, 1) <> chr(10) THEN 1 ELSE 0 END AS BIGINT) AS line_count,
       length(text) - length(replace(text, '|', '')) > 5 AS has_tables,
       regexp_matches(text, {quoted(P.LIST_LINE)}) AS has_lists,
       {S.language_hint()} AS language_hint,
       regexp_matches(text, {quoted(P.EMAIL)}) AS has_email,
       ({_PHONE_HIT}) AS has_phone
FROM documents""")
def text_metadata(spark, sf):
    made = T.text_metadata(F.col("text"))
    return docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in made.items()])


@query("language_hint", f"""
SELECT lang, hint, count(*) AS n FROM (SELECT lang, {S.language_hint()} AS hint FROM documents) GROUP BY lang, hint""")
def language_hint(spark, sf):
    hinted = docs(spark, sf).select("lang", T.language_hint(F.col("text")).alias("hint"))
    return hinted.groupBy("lang", "hint").agg(F.count("*").alias("n"))


def _sql_sections() -> str:
    is_head = " OR ".join(f"regexp_matches(head, {quoted(p)})" for p in FITTED_HEADERS)
    is_foot = " OR ".join(f"regexp_matches(foot, {quoted(p)})" for p in FITTED_FOOTERS)
    return f"""
    lined AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
    edges AS (SELECT *, {S.strip("array_to_string(list_slice(lines, 1, 3), chr(10))")} AS head,
                     {S.strip("array_to_string(list_slice(lines, greatest(len(lines) - 2, 1), len(lines)), chr(10))")} AS foot
              FROM lined),
    marked AS (SELECT *, len(lines) >= 3 AND ({is_head}) AS h, len(lines) >= 3 AND ({is_foot}) AS f FROM edges),
    sections AS (
      SELECT doc_id, text AS "full", CASE WHEN h THEN head ELSE '' END AS header,
             CASE WHEN f THEN foot ELSE '' END AS footer,
             CASE WHEN h OR f THEN {S.strip("array_to_string(list_slice(lines, CASE WHEN h THEN 4 ELSE 1 END, CASE WHEN f THEN len(lines) - 3 ELSE len(lines) END), chr(10))")}
                  ELSE text END AS body
      FROM marked)"""


@query("detect_sections", f"WITH {_sql_sections()} SELECT doc_id, header, body, footer FROM sections")
def detect_sections(spark, sf):
    found = T.detect_sections(F.col("text"), FITTED_HEADERS, FITTED_FOOTERS)
    return docs(spark, sf).select("doc_id", found.alias("s")).select(
        "doc_id", *[F.col("s")[part].alias(part) for part in ("header", "body", "footer")]
    )


@query("explode_sections", f"""
WITH {_sql_sections()},
long AS (
  SELECT doc_id, 'full' AS section, "full" AS raw FROM sections UNION ALL
  SELECT doc_id, 'header', header FROM sections UNION ALL
  SELECT doc_id, 'body', body FROM sections UNION ALL
  SELECT doc_id, 'footer', footer FROM sections),
cleaned AS (SELECT doc_id, section, {S.clean_text('raw')} AS text FROM long WHERE {S.strip('raw')} <> '')
SELECT doc_id, section, text, CAST(length(text) AS BIGINT) AS char_len, {S.est_tokens()} AS tok_len,
       {S.est_tokens()} > 480 AS needs_chunking
FROM cleaned WHERE {S.is_valid_text()}""")
def explode_sections(spark, sf):
    return C.explode_sections(docs(spark, sf), headers=FITTED_HEADERS, footers=FITTED_FOOTERS)


# the section names rotate with the id so that the enumeration rule has something to reject
@query("validate_document_sample", f"""
SELECT doc_id, array_to_string(list_filter([
    CASE WHEN trim(source) = '' THEN 'source_path' END,
    CASE WHEN section NOT IN ('full', 'header', 'body', 'footer') THEN 'section' END,
    CASE WHEN trim(text) = '' THEN 'text' END,
    CASE WHEN n_chars <> length(text) THEN 'char_len' END,
    CASE WHEN {S.est_tokens()} <= 5 THEN 'tok_len' END,
    CASE WHEN {S.est_tokens()} > 480 AND len({S.sentences()}) <= 1 THEN 'chunks' END], lambda x: x IS NOT NULL), '|') AS violations
FROM (SELECT *, CASE WHEN lang = 'es' THEN 'appendix' ELSE 'full' END AS section FROM documents)""")
def validate_document_sample(spark, sf):
    text = F.col("text")
    tok = T.est_tokens_words(text)
    chunks = F.filter(F.transform(F.split(text, P.SENTENCE_END, -1), T.strip), lambda s: s != "")
    rows = docs(spark, sf).withColumn("section", F.when(F.col("lang") == "es", "appendix").otherwise("full"))
    rules = R.document_sample_rules(
        F.col("source"), F.col("doc_id").cast("string"), F.col("section"), text, F.col("n_chars"),
        tok - 5, chunks, tok > 480,
    )
    return rows.select("doc_id", R.joined(R.issues(rules)).alias("violations"))


@query("filter_samples", f"""
WITH {S.SAMPLES}
SELECT doc_id, lang, n_chars FROM samples
WHERE NOT is_ood AND lang IN ('en', 'fr') AND coherence >= 0.6
  AND (CASE WHEN n_chars > 4000 THEN 'complex' WHEN n_chars > 800 THEN 'medium' ELSE 'simple' END) IN ('medium', 'complex')""")
def filter_samples(spark, sf):
    level = F.when(F.col("n_chars") > 4000, "complex").when(F.col("n_chars") > 800, "medium").otherwise("simple")
    rows = samples(spark, sf).withColumn("complexity", level).withColumn("industry", F.col("lang"))
    kept = C.filter_samples(rows, False, ["medium", "complex"], ["en", "fr"], 0.6)
    return kept.select("doc_id", "lang", "n_chars")


@query("problem_samples", f"""
WITH {S.SAMPLES}, judged AS (
SELECT doc_id, substr(text, 1, 100) AS preview, array_to_string(list_filter([
    CASE WHEN coherence < 0.6 THEN 'low_coherence' END,
    CASE WHEN NOT {S.is_valid_text()} THEN 'invalid_text' END,
    CASE WHEN is_ood THEN 'business_logic' END,
    CASE WHEN {S.word_count()} < 5 THEN 'low_extractability' END], lambda x: x IS NOT NULL), '|') AS issues
FROM samples)
SELECT * FROM judged WHERE issues <> ''""")
def problem_samples(spark, sf):
    text = F.col("text")
    rules = [
        ("low_coherence", F.col("coherence") < 0.6),
        ("invalid_text", ~T.is_valid_text(text)),
        ("business_logic", F.col("is_ood")),
        ("low_extractability", T.word_count(text) < 5),
    ]
    found = C.problem_samples(samples(spark, sf), "text", rules)
    return found.select("doc_id", "preview", R.joined(F.col("issues")).alias("issues"))


@query("lookup_by_id", "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id = 42")
def lookup_by_id(spark, sf):
    return table(spark, sf, "documents").where(F.col("doc_id") == 42).select("doc_id", "lang", "source", "n_chars")


@query("lookup_by_batch", "SELECT doc_id, lang, n_chars FROM documents WHERE source = (SELECT min(source) FROM documents)")
def lookup_by_batch(spark, sf):
    rows = table(spark, sf, "documents")
    first = rows.agg(F.min("source").alias("source"))
    return rows.join(F.broadcast(first), "source", "left_semi").select("doc_id", "lang", "n_chars")


@query("list_runs", """
SELECT event_id, event_type, user_id, value FROM events
WHERE event_type IN ('error', 'click') AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'
  AND (contains(lower(CAST(event_id AS VARCHAR)), '7') OR contains(lower(props), '7'))""")
def list_runs(spark, sf):
    events = table(spark, sf, "events").withColumn("status", F.col("event_type"))
    found = C.list_runs(
        events, status=["error", "click"], since=F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"),
        until=F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), q="7", columns=("event_id", "props"),
    )
    return found.select("event_id", "event_type", "user_id", "value")


@query("date_range_filter", """
SELECT span, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events, (VALUES ('last24h', 1), ('last7d', 7), ('last30d', 30)) AS s(span, days)
WHERE ts >= TIMESTAMP '2024-01-25 00:00:00' - to_days(days) AND ts <= TIMESTAMP '2024-01-25 00:00:00'
GROUP BY span""")
def date_range_filter(spark, sf):
    events, now = table(spark, sf, "events"), F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    parts = [
        C.date_range_filter(events, span, now).agg(
            F.lit(span).alias("span"), F.count("*").alias("n"),
            F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
        )
        for span in C.RANGES
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("normalize_markdown", f"""
SELECT doc_id, {S.strip(f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{chr(92)}n+', chr(10), 'g'), '[ {chr(92)}t]+', ' ', 'g'), '{chr(92)}r', '', 'g'), '({P.W}){chr(92)}n({P.W})', '{chr(92)}1 {chr(92)}2', 'g'), '{chr(92)}n{chr(92)}s*{chr(92)}n{chr(92)}s*{chr(92)}n', chr(10) || chr(10), 'g')")} AS text
FROM documents""")
def normalize_markdown(spark, sf):
    return docs(spark, sf).select("doc_id", T.normalize_markdown(F.col("text")).alias("text"))


# rules fitted to words of the driver documents
_TAG_PREAMBLE = ("Released under", "This work", "The the")
_TAG_SECTIONS = (("LICENSE", "LICENSES?"), ("ARTICLES", "THE"), ("CONDITIONS", "WITH"))


@query("tag_sections", f"""
WITH titled AS (SELECT doc_id, '# ' || replace(replace(source || '_' || CAST(doc_id AS VARCHAR) || '.md', '_', ' '), '.md', '') || chr(10) || chr(10) || text AS t FROM documents),
opened AS (SELECT doc_id, CASE
  WHEN regexp_matches(t, '(?i)Released under') THEN regexp_replace(t, '(?i)(Released under)', '## PREAMBLE' || chr(10) || chr(10) || '\\1')
  WHEN regexp_matches(t, '(?i)This work') THEN regexp_replace(t, '(?i)(This work)', '## PREAMBLE' || chr(10) || chr(10) || '\\1')
  WHEN regexp_matches(t, '(?i)The the') THEN regexp_replace(t, '(?i)(The the)', '## PREAMBLE' || chr(10) || chr(10) || '\\1')
  ELSE t END AS t FROM titled),
tagged AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t,
  '(?i)\\b(LICENSES?)\\b', '## LICENSE' || chr(10) || chr(10) || '\\1', 'g'),
  '(?i)\\b(THE)\\b', '## ARTICLES' || chr(10) || chr(10) || '\\1', 'g'),
  '(?i)\\b(WITH)\\b', '## CONDITIONS' || chr(10) || chr(10) || '\\1', 'g') AS t FROM opened)
SELECT doc_id, regexp_replace(t, '(## [^\\n]+)\\n\\n(## [^\\n]+)', '\\1' || chr(10) || '\\2', 'g') AS text FROM tagged""")
def tag_sections(spark, sf):
    title = F.concat_ws("_", F.col("source"), F.concat(F.col("doc_id").cast("string"), F.lit(".md")))
    return docs(spark, sf).select(
        "doc_id", C.tag_sections(F.col("text"), title, _TAG_PREAMBLE, _TAG_SECTIONS).alias("text")
    )


@query("markdown_metadata", f"""
WITH noted AS (SELECT doc_id, source, CASE WHEN contains(lower(text), 'license') THEN '## License' || chr(10) ELSE '' END || text AS text FROM documents)
SELECT doc_id, {S.word_count()} AS word_count, CAST(length(text) AS BIGINT) AS char_count,
       array_to_string(regexp_extract_all(text, '## ([^\\n]+)', 1), '|') AS sections_found,
       CASE WHEN contains(upper(source), '1') THEN 'one' WHEN contains(upper(source), '2') THEN 'two' END AS brand,
       CASE WHEN contains(upper(text), 'LICENSE') OR contains(upper(text), 'PUBLIC') THEN 'INFLUENCER_AGREEMENT' ELSE 'UNKNOWN' END AS document_type
FROM noted""")
def markdown_metadata(spark, sf):
    noted = docs(spark, sf).withColumn(
        "text", F.concat(F.when(F.lower("text").contains("license"), "## License\n").otherwise(""), F.col("text"))
    )
    brand_of = F.when(F.col("source").contains("1"), "one").when(F.col("source").contains("2"), "two")
    made = C.markdown_metadata(F.col("text"), F.coalesce(brand_of, F.lit("")), ("one", "two"), ("LICENSE", "PUBLIC"))
    made["sections_found"] = R.joined(made["sections_found"])
    return noted.select("doc_id", *[c.alias(n) for n, c in made.items()])


# customers as clients; the note names every third client in another way
@query("client_consistency", """
WITH noted AS (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment || ' Pty Ltd' END AS client,
         'signed for ' || CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN 'the cars unit' ELSE c_name END AS text,
         lower(c_mktsegment) AS norm
  FROM customer)
SELECT c_custkey, client IS NULL OR contains(text, norm) OR contains(lower(text), norm || ' pty ltd')
       OR (norm = 'automobile' AND contains(lower(text), 'cars')) AS consistent
FROM noted""")
def client_consistency(spark, sf):
    key = F.col("c_custkey")
    noted = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(key % 5 == 0, None).otherwise(F.concat("c_mktsegment", F.lit(" Pty Ltd"))).alias("client"),
        F.concat(F.lit("signed for "), F.when(key % 3 == 0, F.lower("c_mktsegment")).when(
            key % 3 == 1, F.lit("the cars unit")).otherwise(F.col("c_name"))).alias("text"),
    )
    aliases = small_table(spark, ("name", "variations"), [("automobile", ["cars", "motors"])])
    return C.client_consistency(noted, aliases).select("c_custkey", "consistent")


@query("required_content", f"""
WITH pairs AS (SELECT d.doc_id, d.text, d.source, d.lang, d.n_chars FROM documents d)
SELECT doc_id, contains(lower(text), lower('license')) AS has_client,
       source <> '' AND contains(lower(text), lower(source)) AS has_campaign,
       (contains(text, CAST(n_chars % 10 AS VARCHAR)) OR contains(text, format('{{:,}}', n_chars % 10)))
         AND (contains(lower(text), 'dollar') OR contains(lower(text), 'aud') OR contains(lower(text), '$')) AS has_fee,
       contains(lower(text), 'mail') OR contains(lower(text), 'phone') OR ({' OR '.join(f"contains(lower(text), {quoted(w)})" for w in C.DELIVERABLE_WORDS)}) AS has_deliverable,
       ({' OR '.join(f"contains(lower(text), {quoted(w)})" for w in C.TIMEBOX_WORDS)}) AS has_timebox
FROM pairs""")
def required_content(spark, sf):
    made = C.required_content(
        F.col("text"), F.lit("License"), F.col("source"), F.col("n_chars") % 10,
        F.array(F.lit("Mail"), F.lit("Phone")),
    )
    return docs(spark, sf).select("doc_id", *[c.alias(n) for n, c in made.items()])


@query("rule_token_fit", f"SELECT doc_id, {S.est_tokens()} AS tokens FROM documents WHERE {S.est_tokens()} <= 512")
def rule_token_fit(spark, sf):
    return docs(spark, sf).select("doc_id", T.est_tokens_words(F.col("text")).alias("tokens")).where(F.col("tokens") <= 512)
