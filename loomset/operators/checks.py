"""Row filters and per-row checks over sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import patterns as P
from loomset.functions import rules as R
from loomset.functions import text as T


def explode_sections(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), max_tokens: int = 480,
                     headers=P.HEADER_MARKS, footers=P.FOOTER_MARKS) -> DataFrame:
    """One cleaned row per non-blank, valid section, with its length and token estimate."""
    # cleaned inside the generator: a filter on generated columns is not pushed below it,
    # so every section is cleaned once
    def described(raw: Column) -> Column:
        return T.let(T.clean_text(raw, unicode_form=False), lambda t: F.struct(
            t.alias("text"), T.is_valid_text(t).alias("valid"), F.length(t).cast("long").alias("char_len"),
            T.est_tokens_words(t).alias("tok_len")))

    # most texts have no marked edge: their body is the whole text, which is described already
    def each(found: Column) -> Column:
        return T.let(described(found["full"]), lambda whole: F.transform_values(
            found, lambda _, raw: F.when(raw == found["full"], whole).otherwise(described(raw))))

    sections = T.detect_sections(F.col("normal"), headers, footers)
    made = docs.select(*keep, T.unicode_form_of(F.col(text)).alias("normal")).select(
        *keep, F.explode(T.let(sections, each)).alias("section", "found"))
    return made.where("found.valid").select(
        *keep, "section", "found.text", "found.char_len", "found.tok_len", (F.col("found.tok_len") > max_tokens).alias("needs_chunking"))


def clean_valid(df: DataFrame, text: str = "text", with_text: bool = True, **how) -> DataFrame:
    """Rows whose cleaned text is valid, with its digest and, if wanted, the cleaned text.

    Cleaning runs in a generator, so the filter on its result is not pushed below
    it and every text is cleaned once.
    """
    def described(t: Column) -> Column:
        parts = [T.is_valid_text(t).alias("__valid"), F.md5(t).alias("digest")]
        return F.struct(*parts, t.alias(text)) if with_text else F.struct(*parts)

    made = df.select(*[c for c in df.columns if c != text], F.inline(F.transform(F.array(T.clean_text(F.col(text), **how)), described)))
    return made.where("__valid").drop("__valid")


def filter_samples(
    df: DataFrame, include_ood: bool = True, complexity: Sequence[str] | None = None,
    industry: Sequence[str] | None = None, min_quality: float = 0.0,
) -> DataFrame:
    if not include_ood:
        df = df.where(~F.col("is_ood"))
    if complexity:
        df = df.where(F.col("complexity").isin(*complexity))
    if industry:
        df = df.where(F.col("industry").isin(*industry))
    return df.where(F.col("coherence") >= min_quality) if min_quality > 0 else df


def problem_samples(df: DataFrame, text: str, rules, preview: int = 100) -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules and a text preview."""
    return (
        df.withColumn("issues", R.issues(rules))
        .where(F.size("issues") > 0)
        .withColumn("preview", F.substring(text, 1, preview))
    )


def search_rows(df: DataFrame, needle: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns contains the needle, ignoring case."""
    hit: Column = F.lit(False)
    for name in columns:
        hit = hit | F.lower(F.col(name).cast("string")).contains(needle.lower())
    return df.where(hit)


def list_runs(df: DataFrame, type=None, status: Sequence[str] = (), since=None, until=None, q: str | None = None,
              columns=("id", "type", "status"), ts: str = "ts") -> DataFrame:
    if type:
        df = df.where(F.col("type") == type)
    if status:
        df = df.where(F.col("status").isin(*status))
    if since is not None:
        df = df.where(F.col(ts) >= since)
    if until is not None:
        df = df.where(F.col(ts) <= until)
    return search_rows(df, q, columns) if q else df


# fixed values
RANGES = {"last24h": "INTERVAL '24' HOUR", "last7d": "INTERVAL '7' DAY", "last30d": "INTERVAL '30' DAY"}


def date_range_filter(df: DataFrame, span: str, now: Column, ts: str = "ts") -> DataFrame:
    """Rows of the last day, week or month before ``now``; any other span keeps everything."""
    if span not in RANGES:
        return df
    return df.where((F.col(ts) >= now - F.expr(RANGES[span])) & (F.col(ts) <= now))


# fixed values
COMPANY_SUFFIXES = ("pty ltd", "limited", "ltd", "inc", "corporation", "corp", "australia")


def normalize_client(name: Column, suffixes: Sequence[str] = COMPANY_SUFFIXES) -> Column:
    name = F.lower(name)
    for suffix in suffixes:
        name = F.regexp_replace(name, rf" {suffix}\z", "")
    return F.trim(name)


def client_consistency(df: DataFrame, aliases: DataFrame, client: str = "client", text: str = "text",
                       suffixes: Sequence[str] = COMPANY_SUFFIXES) -> DataFrame:
    """Adds ``consistent``: the client, its normal form or a known variation occurs in the text.

    ``aliases(name, variations)`` holds one row per normal form. Missing client or text passes.
    """
    norm = normalize_client(F.col(client), suffixes)
    low = F.lower(F.col(text))
    joined = df.withColumn("client_norm", norm).join(
        aliases.select(F.col("name").alias("client_norm"), "variations"), "client_norm", "left"
    )
    by_alias = F.exists(F.coalesce("variations", F.array().cast("array<string>")), lambda v: low.contains(F.lower(v)))
    missing = (F.coalesce(F.col(client), F.lit("")) == "") | (F.coalesce(F.col(text), F.lit("")) == "")
    return joined.withColumn(
        "consistent",
        missing | low.contains(F.col("client_norm")) | low.contains(F.lower(F.col(client))) | by_alias,
    ).drop("variations")


# fixed values
MONEY_WORDS = ("dollar", "aud", "$")
DELIVERABLE_WORDS = ("deliverable", "content", "output", "material", "campaign")
TIMEBOX_WORDS = ("period", "term", "timeframe", "duration", "engagement", "timeline", "phase", "milestone")


def any_term(text: Column, terms: Sequence[str]) -> Column:
    hit = F.lit(False)
    for term in terms:
        hit = hit | text.contains(term)
    return hit


def required_content(
    text: Column, client: Column, campaign: Column, fee: Column, deliverables: Column,
    money=MONEY_WORDS, things=DELIVERABLE_WORDS, times=TIMEBOX_WORDS,
) -> dict[str, Column]:
    """Which required parts an agreement text holds."""
    low = F.lower(text)
    mentions = lambda v: F.coalesce((v != "") & low.contains(F.lower(v)), F.lit(False))
    number = text.contains(fee.cast("string")) | text.contains(F.format_number(fee, 0))
    return {
        "has_client": mentions(client),
        "has_campaign": mentions(campaign),
        "has_fee": number & any_term(low, money),
        "has_deliverable": F.exists(deliverables, lambda d: low.contains(F.lower(d))) | any_term(low, things),
        "has_timebox": any_term(low, times),
    }


# fixed values: headings put before the first mention
PREAMBLE_MARKS = (
    "THIS AGREEMENT", "THIS INFLUENCER AGREEMENT", "THIS TALENT AGREEMENT", "INFLUENCER AGREEMENT",
    "TALENT AGREEMENT", "Agreement made", "This Agreement is made",
)
SECTION_MARKS = (
    ("COMMERCIAL TERMS", "COMMERCIAL TERMS?"),
    ("SPECIAL CONDITIONS", "SPECIAL CONDITIONS?"),
    ("ADDITIONAL TERMS", "ADDITIONAL TERMS?"),
    ("PAYMENT TERMS", "PAYMENT TERMS?"),
    ("DELIVERABLES", "DELIVERABLES?"),
    ("CONTENT REQUIREMENTS", "CONTENT REQUIREMENTS?"),
    ("USAGE RIGHTS", "USAGE RIGHTS?"),
    ("EXCLUSIVITY", "EXCLUSIVITY"),
    ("CONFIDENTIALITY", "CONFIDENTIALITY"),
    ("TERMINATION", "TERMINATION"),
    ("SIGNATURES", "SIGNATURES?"),
    ("EXECUTION", "EXECUTION"),
)


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace the leftmost match only. ``pattern`` has one group, ``replacement`` may use ``$2``."""
    return F.regexp_replace(text, rf"(?s)\A(.*?){pattern}", "$1" + replacement)


def tag_sections(text: Column, title: Column, preamble=PREAMBLE_MARKS, sections=SECTION_MARKS) -> Column:
    """Markdown headings: the title, the first preamble mark that occurs, every section mark."""
    tagged = F.concat(F.lit("# "), F.replace(F.replace(title, F.lit("_"), F.lit(" ")), F.lit(".md"), F.lit("")),
                      F.lit("\n\n"), text)
    opened = None
    for mark in preamble:
        case = (tagged.rlike(rf"(?i){mark}"), replace_first(tagged, rf"(?i:({mark}))", "## PREAMBLE\n\n$2"))
        opened = F.when(*case) if opened is None else opened.when(*case)
    tagged = opened.otherwise(tagged) if opened is not None else tagged
    for heading, mark in sections:
        tagged = F.regexp_replace(tagged, rf"(?i)\b({mark})\b", f"## {heading}\n\n$1")
    return F.regexp_replace(tagged, r"(## [^\n]+)\n\n(## [^\n]+)", "$1\n$2")


def markdown_metadata(text: Column, name: Column, brands: Sequence[str], marks: Sequence[str]) -> dict[str, Column]:
    brand = R.first_match([(F.upper(name).contains(b.upper()), b) for b in brands], None)
    return {
        "word_count": T.word_count(text),
        "char_count": F.length(text).cast("long"),
        "sections_found": F.regexp_extract_all(text, F.lit(r"## ([^\n]+)"), F.lit(1)),
        "brand": brand,
        "document_type": F.when(any_term(F.upper(text), marks), "INFLUENCER_AGREEMENT").otherwise("UNKNOWN"),
    }
