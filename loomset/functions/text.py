"""Cleaning, checks and counts on one text column. Everything stays in the JVM but NFKC."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P

UNI = "(?U)"  # \b, \w, \d and \s follow Unicode

# P.ANY_DATE and P.WS_LOOSE for texts that are mostly words: what cannot begin a match is passed by its first character
_DATE = UNI + r"(?=\d|(?i:[JFMASOND]))\b(?:" + "|".join(d.removeprefix(r"\b") for d in P.DATES) + ")"
_LOOSE = rf"(?![!-~])(?:{P.WS_LOOSE})"


_TEXTS_AT_ONCE = 64


def _nfkc(text: str | None) -> str | None:
    return text if text is None else unicodedata.normalize("NFKC", text)


@F.arrow_udf(StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    # a batch is up to 64 MB of text: it stays in Arrow, and only a few texts of it are Python strings at once
    parts = [texts.slice(at, _TEXTS_AT_ONCE) for at in range(0, len(texts), _TEXTS_AT_ONCE)] or [texts]
    return pa.concat_arrays([pa.array(map(_nfkc, p.to_pylist()), pa.string(), size=len(p)) for p in parts])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def let_all(values: dict[str, Column], body) -> Column:
    """As :func:`let` for several values; ``body`` gets them as fields of one struct."""
    return let(F.struct(*[c.alias(n) for n, c in values.items()]), body)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(P.WORD_RUN)).cast("long")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(P.WORD_RUN), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-cased word tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.TOKEN), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(P.WS_CHARS))


def redact_email(text: Column) -> Column:
    return F.when(text.contains("@"), F.regexp_replace(text, UNI + P.EMAIL, "[EMAIL]")).otherwise(text)


def redact_phone(text: Column) -> Column:
    changed = text
    for pattern in P.PHONES:
        changed = F.regexp_replace(changed, UNI + pattern, "[PHONE]")
    return F.when(has_digit(text), changed).otherwise(text)


def redact_ssn(text: Column) -> Column:
    return F.regexp_replace(text, UNI + P.SSN, "[SSN]")


def redact_pii(text: Column, emails: bool = True, phones: bool = True, ssns: bool = False) -> Column:
    if emails:
        text = redact_email(text)
    if phones:
        text = redact_phone(text)
    return redact_ssn(text) if ssns else text


def outside_dates(text: Column, change) -> Column:
    """Apply ``change`` to the stretches between dates; the dates come back untouched."""
    gaps = F.transform(F.split(text, _DATE, -1), change)
    dates = F.regexp_extract_all(text, F.lit(_DATE), F.lit(0))
    joined = F.array_join(
        F.zip_with(gaps, dates, lambda g, d: F.concat(g, F.coalesce(d, F.lit("")))), ""
    )
    return F.when(text.rlike(_DATE), joined).otherwise(change(text))


def normalize_quotes(text: Column) -> Column:
    return F.replace(F.translate(text, "“”‘’", "\"\"''"), F.lit("…"), F.lit("..."))


def normalize_currency(text: Column, strict: bool = False) -> Column:
    """``$ 1,234``, ``1,234 dollars`` and ``USD 1,234`` become ``$1,234``.

    An amount that carries both a sign and the word gets two signs; ``strict``
    keeps one.
    """
    for pattern in P.MONEY:
        text = F.regexp_replace(text, UNI + pattern, r"\$$1")
    return F.regexp_replace(text, r"\${2,}(?=\d)", r"\$") if strict else text


def squeeze(text: Column) -> Column:
    """Every run of whitespace as one space; plain single spaces are not touched."""
    return F.regexp_replace(text, _LOOSE, " ")


def normalize_whitespace(text: Column) -> Column:
    return F.trim(squeeze(text))


def has_digit(text: Column) -> Column:
    """Phones, dates, money and the like need one; a cheap test before their patterns."""
    return text.rlike(r"\p{Nd}")


def _stable_ranges() -> str:
    """Ranges of common scripts whose characters NFKC neither changes nor joins with a neighbour, for a character class."""
    joined = {d[1] for c in range(0x110000) if len(d := unicodedata.decomposition(chr(c)).split()) == 2 and d[0][0] != "<"}

    def stable(c: int) -> bool:
        char = chr(c)
        return unicodedata.is_normalized("NFKC", char) and not unicodedata.combining(char) and f"{c:04X}" not in joined

    kept = [c for low, high in _SCRIPTS for c in range(low, high + 1) if stable(c)]
    starts = [c for c, before in zip(kept, [-2, *kept]) if c != before + 1]
    ends = [c for c, after in zip(kept, [*kept[1:], -2]) if c != after - 1]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends))


# Latin, Greek and Cyrillic, Hebrew and Arabic letters, punctuation, currency signs, kana, Han, Hangul
_SCRIPTS = (
    (0x80, 0x24F), (0x370, 0x4FF), (0x5D0, 0x5EA), (0x621, 0x64A), (0x2010, 0x205E), (0x20A0, 0x20BF), (0x3001, 0x30FF),
    (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
)
_UNSTABLE = f"[^{_stable_ranges()}]"


def unicode_form_of(text: Column) -> Column:
    """NFKC; only texts with a character that it might change leave the JVM."""
    beyond = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.coalesce(nfkc(F.when(beyond.rlike(_UNSTABLE), text)), text)


def clean_text(
    text: Column,
    emails: bool = True,
    phones: bool = True,
    ssns: bool = False,
    unicode_form: bool = True,
) -> Column:
    """The whole cleaning chain; null gives the empty string.

    NFKC comes first, the one step that needs Python: only texts that it might change go there.
    """
    if unicode_form:
        text = unicode_form_of(text)
    text = F.coalesce(text, F.lit(""))

    def between_dates(piece: Column) -> Column:
        return squeeze(normalize_currency(normalize_quotes(redact_pii(piece, emails, phones, ssns))))

    plain = squeeze(normalize_quotes(redact_email(text) if emails else text))
    return F.trim(F.when(has_digit(text), outside_dates(text, between_dates)).otherwise(plain))


def special_share(text: Column) -> Column:
    """Share of characters that are neither letters, numbers nor whitespace."""
    marks = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s\x0b\x1c-\x1f\x85\p{Z}]+", ""))
    return F.try_divide(marks.cast("double"), F.length(text).cast("double"))


def is_valid_text(text: Column, min_chars: int = 10, max_special: float = 0.5) -> Column:
    ok = (F.length(strip(text)) >= min_chars) & (special_share(text) <= max_special)
    return F.coalesce(ok, F.lit(False))


def line_count(text: Column) -> Column:
    """Lines as a text editor counts them: a final line break opens no new line."""
    marks = F.length(text) - F.length(F.translate(text, P.LINE_BREAKS, ""))
    pairs = F.length(text) - F.length(F.replace(text, F.lit("\r\n"), F.lit("\n")))
    open_end = F.when((text != "") & ~F.right(text, F.lit(1)).isin(*P.LINE_BREAKS), 1).otherwise(0)
    return (marks - pairs + open_end).cast("long")


def language_hint(text: Column, sample: int = 100) -> Column:
    def judge(found: Column) -> Column:
        hits = F.size(F.filter(F.slice(found, 1, sample), lambda t: t.isin(*P.ENGLISH_HINTS)))
        share = F.try_divide(hits.cast("double"), F.least(F.size(found), F.lit(sample)).cast("double"))
        return F.when((F.size(found) >= 10) & (share > 0.1), "en").otherwise("unknown")

    return let(tokens(text), judge)


def text_metadata(text: Column) -> dict[str, Column]:
    phone = F.lit(False)
    for pattern in P.PHONES:
        phone = phone | text.rlike(UNI + pattern)
    return {
        "char_count": F.length(text).cast("long"),
        "word_count": word_count(text),
        "line_count": line_count(text),
        "has_tables": (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))) > 5,
        "has_lists": text.rlike(P.LIST_LINE),
        "language_hint": language_hint(text),
        "has_email": text.contains("@") & text.rlike(UNI + P.EMAIL),
        "has_phone": has_digit(text) & phone,
    }


def detect_sections(text: Column, headers=P.HEADER_MARKS, footers=P.FOOTER_MARKS, edge: int = 3) -> Column:
    """Map of full, header, body and footer. Texts of fewer than ``edge`` lines have a body only."""

    def cut(lines: Column) -> Column:
        n = F.size(lines)
        edges = {
            "head": strip(F.array_join(F.slice(lines, 1, edge), "\n")),
            "foot": strip(F.array_join(F.slice(lines, F.greatest(n - edge + 1, F.lit(1)), edge), "\n")),
        }
        return let_all(edges, lambda e: marked(lines, n, e["head"], e["foot"]))

    def marked(lines: Column, n: Column, head: Column, foot: Column) -> Column:
        is_head, is_foot = F.lit(False), F.lit(False)
        for pattern in headers:
            is_head = is_head | head.rlike(pattern)
        for pattern in footers:
            is_foot = is_foot | foot.rlike(pattern)
        marks = {"head": (n >= edge) & is_head, "foot": (n >= edge) & is_foot}
        return let_all(marks, lambda m: parts(lines, n, head, foot, m["head"], m["foot"]))

    def parts(lines: Column, n: Column, head: Column, foot: Column, is_head: Column, is_foot: Column) -> Column:
        start = F.when(is_head, edge + 1).otherwise(1)
        stop = F.when(is_foot, n - edge).otherwise(n)
        inner = strip(F.array_join(F.slice(lines, start, F.greatest(stop - start + 1, F.lit(0))), "\n"))
        return F.create_map(
            F.lit("full"), text,
            F.lit("header"), F.when(is_head, head).otherwise(""),
            F.lit("body"), F.when(is_head | is_foot, inner).otherwise(text),
            F.lit("footer"), F.when(is_foot, foot).otherwise(""),
        )

    return let(F.split(text, "\n", -1), cut)


def normalize_markdown(text: Column) -> Column:
    text = F.regexp_replace(text, r"\n+", "\n")
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"\r", "")
    text = F.regexp_replace(text, rf"({P.W})\n({P.W})", "$1 $2")
    return strip(F.regexp_replace(text, r"\n\s*\n\s*\n", "\n\n"))


def est_tokens_words(text: Column) -> Column:
    return F.floor(word_count(text) * F.lit(1.33)).cast("long")


def est_tokens_chars(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("long")


def fold_rules(text: Column, rules) -> Column:
    """Apply (pattern, replacement) pairs in order."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text
