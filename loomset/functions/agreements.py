"""Rules on fees, deliverables, platforms and terms.

Rules take numbers and flags, which come either from the arrays of a nested
sample or from an aggregate over a deliverables table; see
:func:`item_features` and :func:`item_aggregates`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import Rule, first_match, issues
from .text import let

# fixed values
BRACKETS = {
    "simple": dict(low=500, high=2500, base=200, video=2.0, reel=1.5, exclusivity=1.3, usage=1.2),
    "medium": dict(low=2000, high=8000, base=400, video=2.5, reel=1.8, exclusivity=1.5, usage=1.4),
    "complex": dict(low=6000, high=25000, base=800, video=3.0, reel=2.2, exclusivity=1.8, usage=1.6),
}
INDUSTRY_FACTOR = {"fashion": 1.1, "beauty": 1.2, "tech": 1.3, "food": 1.0, "home": 0.9, "other": 1.0}
USAGE_RANGE = {"basic": (3, 12), "medium": (6, 18), "high": (12, 24), "premium": (18, 36)}
PLATFORM_WORDS = {
    "instagram": ("instagram", "ig", "insta"), "youtube": ("youtube", "yt", "video"), "tiktok": ("tiktok", "tt"),
    "pinterest": ("pinterest",), "linkedin": ("linkedin",), "facebook": ("facebook", "fb"), "twitter": ("twitter",),
    "snapchat": ("snapchat", "snap"),
}
EXPECTED_PLATFORMS = {
    "beauty": ("instagram", "youtube", "tiktok"), "fashion": ("instagram", "pinterest", "tiktok"),
    "tech": ("linkedin", "youtube", "twitter"), "food": ("instagram", "tiktok", "youtube"),
    "home": ("pinterest", "instagram", "youtube"), "other": ("instagram", "youtube", "tiktok", "linkedin"),
}
PLATFORM_FIT = {
    "fashion": (("instagram", "tiktok", "pinterest"), ("facebook", "youtube", "twitter"), ("linkedin",)),
    "food": (("instagram", "tiktok", "youtube"), ("facebook", "pinterest", "twitter"), ("linkedin",)),
    "tech": (("youtube", "twitter", "linkedin"), ("instagram", "tiktok", "facebook"), ("pinterest",)),
    "beauty": (("instagram", "tiktok", "youtube"), ("pinterest", "facebook", "twitter"), ("linkedin",)),
    "home": (("instagram", "pinterest", "youtube"), ("facebook", "tiktok", "twitter"), ("linkedin",)),
    "travel": (("instagram", "youtube", "tiktok"), ("facebook", "pinterest", "twitter"), ("linkedin",)),
    "finance": (("linkedin", "youtube", "twitter"), ("facebook", "instagram"), ("tiktok", "pinterest")),
}
WEEKS_PER_MONTH = 4.33


def _any(item: Column, terms: Sequence[str]) -> Column:
    hit = F.lit(False)
    for term in terms:
        hit = hit | item.contains(term)
    return hit


# what one deliverable is counted as
KINDS = {
    "posts": lambda d: d.contains("post"),
    "videos": lambda d: _any(d, ("video", "igtv", "tutorial")),
    "reels": lambda d: d.contains("reel"),
    "stories": lambda d: _any(d, ("story", "stories")),
    "video_class": lambda d: _any(d, ("video", "igtv", "youtube")),
    "reel_class": lambda d: ~_any(d, ("video", "igtv", "youtube")) & _any(d, ("reel", "tiktok")),
    "exclusive": lambda d: d.contains("exclusiv"),
    "usage": lambda d: d.contains("usage"),
}


def item_flags(low: Column) -> dict[str, Column]:
    """What a lower-cased deliverable counts as, and the platforms it names."""
    out = {name: kind(low) for name, kind in KINDS.items()}
    return out | {f"on_{name}": _any(low, words) for name, words in PLATFORM_WORDS.items()}


def item_aggregates() -> dict[str, Column]:
    """Aggregates over the flags of a deliverables table: the count, the count of each kind, the platforms named."""
    out = {"items": F.count("*")}
    out |= {name: F.count_if(F.col(name)) for name in KINDS}
    return out | {"platforms": _platforms_named()}


def _platforms_named() -> Column:
    named = [F.when(F.bool_or(F.col(f"on_{name}")), F.lit(name)) for name in PLATFORM_WORDS]
    return F.array_compact(F.array(*named))


def equal_item_aggregates() -> dict[str, Column]:
    """Aggregates over the flags of equal deliverables: the count, the count of each kind, which platforms are named."""
    out = {"items": F.count("*")} | {name: F.count_if(F.col(name)) for name in KINDS}
    return out | {f"on_{name}": F.bool_or(F.col(f"on_{name}")) for name in PLATFORM_WORDS}


def counted_item_flags(item: Column, items: Column) -> dict[str, Column]:
    """The columns of :func:`equal_item_aggregates` for one row of ``items`` equal deliverables.

    ``item`` may be the normal form: no word that is searched for holds white space, so both forms hold the same ones.
    """
    flags = item_flags(item)
    out = {"items": items} | {name: F.when(flags[name], items).otherwise(0) for name in KINDS}
    return out | {name: flag for name, flag in flags.items() if name not in KINDS}


def distinct_item_aggregates(item: str) -> dict[str, Column]:
    """As :func:`item_aggregates`, from the rows of :func:`equal_item_aggregates`, and what repeats among them."""
    repeated = F.col("items") > 1
    out = {name: F.sum(name) for name in ("items", *KINDS)} | {"platforms": _platforms_named()}
    return out | {
        "duplicates": F.count_if(repeated), "distinct_items": F.count("*"), "first_duplicate": F.min(F.when(repeated, F.col(item)))}


def item_features(items: Column) -> dict[str, Column]:
    """The same from an array of deliverables in one row."""
    low = F.transform(items, F.lower)
    out = {"items": F.size(items).cast("long")}
    out |= {name: F.size(F.filter(low, kind)).cast("long") for name, kind in KINDS.items()}
    return out | {"platforms": platforms_in(items)}


def platforms_in(items: Column, words=PLATFORM_WORDS) -> Column:
    low = F.transform(items, F.lower)
    return F.array_compact(F.array(*[
        F.when(F.exists(low, lambda d: _any(d, w)), F.lit(name)) for name, w in words.items()]))


def normal_item(item: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(item)), r"\s+", " ")


def duplicate_items(items: Column) -> Column:
    """Normal forms that occur more than once."""
    norm = F.transform(items, normal_item)
    return F.filter(F.array_distinct(norm), lambda x: F.size(F.filter(norm, lambda y: y == x)) > 1)


def weeks_in(term: Column) -> Column:
    return F.coalesce(F.regexp_extract(term, r"(\d+)\s*weeks?", 1).try_cast("int"), F.lit(0))


def months_in(term: Column) -> Column:
    return F.coalesce(F.regexp_extract(term, r"(\d+)\s*months?", 1).try_cast("int"), F.lit(0))


def term_months(term: Column) -> Column:
    """Length in months; a length in weeks wins."""
    return let(weeks_in(term), lambda weeks: F.when(weeks > 0, weeks / WEEKS_PER_MONTH).otherwise(months_in(term).cast("double")))


def fee_tier(fee: Column) -> Column:
    return first_match([(fee >= 15000, "premium"), (fee >= 5000, "high"), (fee >= 2000, "medium")], "basic")


def usage_range(tier: Column) -> Column:
    low = first_match([(tier == k, v[0]) for k, v in USAGE_RANGE.items()], 6)
    high = first_match([(tier == k, v[1]) for k, v in USAGE_RANGE.items()], 18)
    return F.struct(low.alias("min_months"), high.alias("max_months"))


def agreement_class(fee: Column, items: Column) -> Column:
    return first_match(
        [(fee > 50000, "HIGH_VALUE_PARTNERSHIP"), (fee > 15000, "STANDARD_COLLABORATION"), (items > 3, "MULTI_CONTENT_CAMPAIGN")],
        "BASIC_INFLUENCER_AGREEMENT")


def _bracket(complexity: Column, name: str) -> Column:
    return first_match([(complexity == k, float(v[name])) for k, v in BRACKETS.items()], float(BRACKETS["medium"][name]))


def expected_fee(complexity: Column, industry: Column, posts: Column, stories: Column, videos: Column, reels: Column) -> Column:
    low, high, base = (_bracket(complexity, n) for n in ("low", "high", "base"))
    fee = (
        low + posts * base + stories * (base * 0.3) + videos * base * _bracket(complexity, "video")
        + reels * base * _bracket(complexity, "reel")
    ) * first_match([(industry == k, v) for k, v in INDUSTRY_FACTOR.items()], 1.0)
    return (F.bround(F.greatest(low, F.least(high, F.floor(fee).cast("double"))) / 50) * 50).cast("long")


def rule_fee_deliverables(fee: Column, items: Column) -> list[Rule]:
    return [("fee_range", (fee < 50) | (fee > 100000)), ("item_count", (items == 0) | (items > 25))]


def few_items_warning(fee: Column, items: Column) -> Column:
    """Fewer than a third of one item per thousand."""
    expected = F.greatest(F.lit(1), F.floor(fee / 1000))
    return (fee > 0) & (items > 0) & (items < expected / 3)


def aligned_range(complexity: Column, items: Column, videos: Column, reels: Column, exclusive: Column, usage: Column) -> Column:
    """Struct of the expected fee and its allowed bounds."""
    many = F.pow(_bracket(complexity, "video"), videos) * F.pow(_bracket(complexity, "reel"), reels)
    many = many * F.when(exclusive > 0, _bracket(complexity, "exclusivity")).otherwise(1.0)
    many = many * F.when(usage > 0, _bracket(complexity, "usage")).otherwise(1.0)
    fee = items * _bracket(complexity, "base") * many
    return F.struct(
        fee.alias("expected"), F.greatest(_bracket(complexity, "low"), fee * 0.7).alias("low"),
        F.least(_bracket(complexity, "high"), fee * 1.5).alias("high"))


def rule_fee_alignment(fee: Column, allowed: Column) -> Column:
    return (fee >= allowed["low"]) & (fee <= allowed["high"])


def rule_platform(industry: Column, platforms: Column) -> Column:
    """No platform named, or at least one that suits the industry."""
    suits = first_match(
        [(F.lower(industry) == k, F.array(*[F.lit(p) for p in v])) for k, v in EXPECTED_PLATFORMS.items() if k != "other"],
        F.array(*[F.lit(p) for p in EXPECTED_PLATFORMS["other"]]))
    return (F.size(platforms) == 0) | F.arrays_overlap(platforms, suits)


def rule_temporal(exclusivity: Column, usage: Column, engagement: Column) -> list[Rule]:
    def outside(months: Column, low: float, high: float) -> Column:
        return let(months, lambda m: (m > 0) & ((m < low) | (m > high)))

    return [
        ("exclusivity", outside(term_months(exclusivity), 1, 48)),
        ("usage_term", outside(months_in(usage), 1, 60)),
        ("engagement", outside(term_months(engagement), 0.25, 24)),
    ]


def rule_temporal_lenient(exclusivity: Column, engagement: Column, max_exclusivity: float) -> Column:
    return (term_months(exclusivity) <= max_exclusivity) & (months_in(engagement) <= 24)


def lenient_unique(items: Column, distinct: Column, share: float = 0.2) -> Column:
    """At most a fifth of the items are repeats."""
    return F.coalesce(1 - F.try_divide(distinct.cast("double"), items.cast("double")) <= share, F.lit(True))


def validate_agreement(business: list[Rule], temporal: list[Rule], duplicates: Column, platform_ok: Column) -> dict[str, Column]:
    business_ok, temporal_ok = F.size(issues(business)) == 0, F.size(issues(temporal)) == 0
    unique = duplicates == 0
    return {
        "business_ok": business_ok, "temporal_ok": temporal_ok, "deliverable_unique": unique, "platform_aligned": platform_ok,
        "overall_valid": business_ok & temporal_ok & unique & platform_ok,
    }


def campaign_rules(fee: Column, items: Column, industry: Column, platforms: Column, months: Column, exclusivity: Column,
                   fit=PLATFORM_FIT) -> list[Rule]:
    """Contradictions between fee and deliverables, industry and platforms, campaign and exclusivity."""
    industry = F.lower(industry)
    low = F.transform(platforms, F.lower)
    some = F.size(platforms) > 0
    has = lambda p: F.array_contains(low, p)
    listed = lambda i: F.array(*[F.lit(p) for p in i])
    poor, unsuited = F.lit(False), F.lit(False)
    for name, (preferred, acceptable, bad) in fit.items():
        here = industry == name
        poor = poor | (here & F.arrays_overlap(low, listed(bad)))
        unsuited = unsuited | (here & ~F.arrays_overlap(low, listed(preferred + acceptable)))
    timed = (months > 0) & (exclusivity >= 0)
    return [
        ("low_fee_many_items", (fee < 5000) & (items > 5)),
        ("mid_fee_very_many_items", (fee >= 5000) & (fee < 15000) & (items > 10)),
        ("mid_fee_few_items", (fee >= 5000) & (fee < 15000) & (items < 2)),
        ("high_fee_few_items", (fee >= 35000) & (items < 5)),
        ("no_items", items <= 0),
        ("extreme_fee", (fee > 100000) & (items < 10)),
        ("no_platform", ~some),
        ("poor_platform", some & poor),
        ("no_suitable_platform", some & unsuited),
        ("linkedin_consumer", some & has("linkedin") & ~industry.isin("tech", "finance", "business")),
        ("tiktok_finance", some & has("tiktok") & (industry == "finance")),
        ("no_campaign_length", months <= 0),
        ("negative_exclusivity", (months > 0) & (exclusivity < 0)),
        ("exclusivity_short", timed & (exclusivity < months)),
        ("exclusivity_excessive", timed & (months <= 1) & (exclusivity > 6)),
        ("exclusivity_too_long", timed & (months >= 6) & (exclusivity > months * 3)),
        ("exclusivity_over_maximum", timed & (exclusivity > 24)),
        ("exclusivity_short_term", timed & (months <= 2) & (exclusivity > 12)),
    ]


def auto_adjust(found: Column, fee: Column, items: Column, months: Column, exclusivity: Column) -> dict[str, Column]:
    """Repaired fee and exclusivity for the issues that can be repaired; the last repair wins."""
    has = lambda name: F.array_contains(found, name)
    raised = F.when(items > 5, F.greatest(F.lit(15000.0), items * 2500.0)).otherwise(F.greatest(F.lit(8000.0), items * 2000.0))
    lowered = F.least(fee * 0.7, items * 4000.0)
    new_fee = F.when(has("high_fee_few_items"), lowered).when(has("low_fee_many_items"), raised).otherwise(fee.cast("double"))
    new_exclusivity = (
        F.when(has("exclusivity_excessive"), F.least(F.lit(12.0), months * 3.0))
        .when(has("exclusivity_short"), months * 2.0).otherwise(exclusivity.cast("double"))
    )
    return {"fee": new_fee, "exclusivity": new_exclusivity}


def rule_score_simple(fee: Column, items: Column, clash: Column) -> Column:
    """Score of the first rule that speaks: fee per item, platform clash, fee range."""
    return first_match(
        [((items > 0) & (fee / F.greatest(items, F.lit(1)) > 10000), 0.3), (clash, 0.4), ((fee < 1000) | (fee > 50000), 0.2)], 0.7)


# fixed values
ONES = ("", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
        "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
TENS = ("", "", "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")


def number_to_words(amount: Column) -> Column:
    """English words up to 999,999, above that the number itself."""
    ones, tens = F.array(*[F.lit(w) for w in ONES]), F.array(*[F.lit(w) for w in TENS])

    def below_thousand(n: Column) -> Column:
        rest = n % 100
        small = F.element_at(ones, F.when(rest < 20, rest).otherwise(rest % 10).cast("int") + 1)
        ten = F.element_at(tens, F.when(rest < 20, 0).otherwise(F.floor(rest / 10)).cast("int") + 1)
        hundred = F.when(n >= 100, F.concat(F.element_at(ones, F.floor(n / 100).cast("int") + 1), F.lit(" hundred")))
        none = lambda w: F.when(w != "", w)
        return F.concat_ws(" ", hundred, none(ten), none(small))

    thousands, rest = F.floor(amount / 1000), amount % 1000
    spoken = F.concat_ws(" ", F.when(thousands > 0, F.concat(below_thousand(thousands % 1000), F.lit(" thousand"))),
                         F.when(rest > 0, below_thousand(rest)))
    return (
        F.when(amount == 0, "zero").when(amount < 1000000, spoken)
        .otherwise(F.concat(F.lit("approximately "), F.format_number(amount, 0)))
    )


# fixed values: (?s) lets a field run over line ends where the source pattern does
FIELD_PATTERNS = {
    "client": (r"(?i)agreement is between (.+?) and", r"(?i)on behalf of ([^.]+)"),
    "brand": (r"(?i)behalf of ([^.]+)",),
    "campaign": (r"(?i)for the ([^.]+campaign[^.]*)",),
    "engagement_term": (r"(?i)Engagement Period: ([^\n]+)",),
    "usage_term": (r"(?i)Usage Rights: ([^\n]+)",),
}
FEE_PATTERNS = (r"(?i)Total Fee: \$?([\d,]+)", r"(?i)Fee: \$?([\d,]+)", r"(?i)\$?([\d,]+) AUD")
INDUSTRY_WORDS = (("tech", ("tech", "technology", "innovation", "digital")), ("fashion", ("fashion", "beauty", "style", "wellness")))


def _first_found(text: Column, patterns: Sequence[str]) -> Column:
    found = [F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found, F.lit(""))


def extract_fields(text: Column) -> dict[str, Column]:
    """The fields of an agreement text by the first pattern that matches; empty when none does."""
    out = {name: F.trim(_first_found(text, patterns)) for name, patterns in FIELD_PATTERNS.items()}
    amount = _first_found(text, FEE_PATTERNS)
    out["fee"] = F.when(amount != "", F.concat(F.lit("$"), amount)).otherwise("")
    out["fee_numeric"] = F.replace(amount, F.lit(","), F.lit("")).try_cast("long")
    section = F.regexp_extract(text, r"(?is)DELIVERABLES:(.*?)(?:\n\n|\nTERMS|\z)", 1)
    lines = F.filter(F.split(section, "\n", -1), lambda line: F.trim(line).startswith("-"))
    out["deliverables"] = F.transform(lines, lambda line: F.trim(F.regexp_replace(line, r"^-\s*", "")))
    low = F.lower(text)
    out["industry"] = first_match([(_any(low, words), name) for name, words in INDUSTRY_WORDS], "general")
    return out
