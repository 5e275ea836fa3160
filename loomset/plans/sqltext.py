"""SQL snippets shared by the comparison queries. They mirror loomset.functions.text."""

from __future__ import annotations

from loomset.functions import patterns as P

from .registry import quoted


def word_count(text: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({text}, {quoted(P.WORD_RUN)})) AS BIGINT)"


def words(text: str = "text") -> str:
    return f"regexp_extract_all({text}, {quoted(P.WORD_RUN)})"


def tokens(text: str = "text") -> str:
    return f"regexp_extract_all(lower({text}), {quoted(P.TOKEN)})"


def strip(text: str = "text") -> str:
    return f"regexp_replace({text}, {quoted(rf'\A{P.WS_RUN}|{P.WS_RUN}\z')}, '', 'g')"


def squeeze(text: str = "text") -> str:
    return f"trim(regexp_replace({text}, {quoted(P.WS_RUN)}, ' ', 'g'))"


def est_tokens(text: str = "text") -> str:
    return f"CAST(floor({word_count(text)} * 1.33::DOUBLE) AS BIGINT)"


def redact_email(text: str = "text") -> str:
    return f"regexp_replace({text}, {quoted(P.EMAIL)}, '[EMAIL]', 'g')"


def redact_pii(text: str = "text") -> str:
    out = redact_email(text)
    for pattern in P.PHONES:
        out = f"regexp_replace({out}, {quoted(pattern)}, '[PHONE]', 'g')"
    return out


def normalize_quotes(text: str = "text") -> str:
    return f"replace(translate({text}, '“”‘’', '\"\"'''''), '…', '...')"


def normalize_currency(text: str = "text") -> str:
    out = text
    for pattern in P.MONEY:
        out = f"regexp_replace({out}, {quoted(pattern)}, '$\\1', 'g')"
    return out


def clean_text(text: str = "text") -> str:
    # no text of the driver tables holds a date, so protection has nothing to do here
    return squeeze(normalize_currency(normalize_quotes(redact_pii(f"coalesce({text}, '')"))))


def is_valid_text(text: str = "text") -> str:
    marks = rf"[\p{{L}}\p{{N}}\s\x0b\x1c-\x1f\x85\p{{Z}}]"
    return (
        f"coalesce(length({strip(text)}) >= 10 AND "
        f"length(regexp_replace({text}, {quoted(marks)}, '', 'g')) / nullif(length({text}), 0) <= 0.5, false)"
    )


def sentences(text: str = "text") -> str:
    return (
        f"list_filter(list_transform(string_split_regex({text}, {quoted(P.SENTENCE_END)}), "
        f"lambda s: {strip('s')}), lambda s: s <> '')"
    )


def language_hint(text: str = "text") -> str:
    hints = ", ".join(quoted(w) for w in P.ENGLISH_HINTS)
    return (
        f"CASE WHEN len({tokens(text)}) >= 10 AND "
        f"len(list_filter(list_slice({tokens(text)}, 1, 100), lambda t: t IN ({hints}))) "
        f"/ least(len({tokens(text)}), 100) > 0.1 THEN 'en' ELSE 'unknown' END"
    )


# every document with the label columns; a document without labels counts as coherent and not toxic
SAMPLES = """
samples AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         CAST(coalesce(l.quality, 1) AS DOUBLE) AS coherence,
         coalesce(l.toxic, 0) = 1 AS is_ood
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""

# train, val and test by the digest of the id
SPLIT_OF_ID = (
    "CASE WHEN substr(md5('42|' || CAST({id} AS VARCHAR)), 1, 4) < 'b333' THEN 'train' "
    "WHEN substr(md5('42|' || CAST({id} AS VARCHAR)), 1, 4) < 'd999' THEN 'val' ELSE 'test' END"
)


def split_of(column: str = "doc_id") -> str:
    return SPLIT_OF_ID.format(id=column)


DOC_LABELS = f"""
doc_labels AS (
  SELECT d.doc_id, d.source, {split_of('d.doc_id')} AS split,
         list_filter([d.lang,
           CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END,
           CASE WHEN l.toxic = 1 THEN 'toxic' END,
           CASE WHEN d.n_chars > 4000 THEN 'long' WHEN d.n_chars > 800 THEN 'mid' ELSE 'short' END,
           CASE WHEN contains(d.text, chr(10)) THEN 'multiline' END,
           CASE WHEN contains(d.text, '@') THEN 'has_email' END], lambda x: x IS NOT NULL) AS labels
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""
