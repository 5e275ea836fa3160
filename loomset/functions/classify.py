"""Lexicon-based classes and scores. Lexicons are parameters; the defaults are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .rules import first_match, term_occurrences, terms_present
from .text import let, let_all, strip, word_count

INFLUENCER_TERMS = (
    "influencer", "content", "social media", "instagram", "tiktok", "post", "story", "reel", "video",
    "collaboration", "campaign", "deliverable", "follower", "engagement", "brand ambassador",
)
OTHER_TERMS = (
    "employment", "employee", "salary", "wage", "job", "position", "supplier", "vendor", "purchase", "sale",
    "property", "rental", "lease", "loan", "mortgage", "insurance", "medical", "legal",
)
COMPLEX_TERMS = (
    "exclusivity", "usage rights", "territory", "licensing", "intellectual property", "termination", "breach",
    "indemnification", "liability", "warranty",
)
INDUSTRY_TERMS = (
    ("fashion", ("fashion", "clothing", "outfit", "style", "apparel", "dress", "shoes", "accessories", "jewelry", "handbag")),
    ("beauty", ("beauty", "makeup", "skincare", "cosmetics", "lipstick", "foundation", "mascara", "moisturizer", "serum", "facial")),
    ("food", ("food", "recipe", "cooking", "meal", "restaurant", "delivery", "kitchen", "ingredient", "nutrition", "diet")),
    ("tech", ("technology", "tech", "smartphone", "laptop", "software", "app", "device", "gadget", "electronics", "digital")),
    ("home", ("home", "decor", "furniture", "interior", "design", "room", "kitchen", "bedroom", "living", "organization")),
)
STRONG_POSITIVE = (
    "influencer", "content creator", "brand partnership", "collaboration", "social media campaign",
    "sponsored content", "brand ambassador", "product review", "content creation", "instagram post", "youtube video",
)
MODERATE_POSITIVE = (
    "deliverable", "fee", "payment", "exclusivity", "usage rights", "territory", "campaign", "brand", "product",
    "audience", "engagement", "reach", "impression", "follower",
)
PLATFORM_TERMS = (
    "instagram", "youtube", "tiktok", "facebook", "twitter", "linkedin", "pinterest", "snapchat", "story", "reel", "post",
)
STRONG_NEGATIVE = (
    "employment", "employee", "salary", "wage", "full-time", "part-time", "benefits", "vacation", "sick leave",
    "banking", "loan", "mortgage", "insurance", "medical", "real estate", "property", "lease", "rent", "tenant",
)
MODERATE_NEGATIVE = (
    "supplier", "vendor", "procurement", "tender", "clinical trial", "research study", "academic", "government", "public sector",
)
LEGAL_TERMS = (
    "intellectual property", "confidentiality", "non-disclosure", "termination", "indemnification", "liability",
    "jurisdiction", "arbitration", "breach", "governing law", "force majeure", "assignment", "amendment",
)
FINANCIAL_TERMS = ("fee", "payment", "royalty", "commission", "bonus", "penalty")


def classify_doc_type(text: Column, yes=INFLUENCER_TERMS, no=OTHER_TERMS) -> Column:
    def judge(s: Column) -> Column:
        return F.when((s["yes"] > s["no"]) & (s["yes"] >= 2), "INFLUENCER_AGREEMENT").otherwise("NOT_INFLUENCER")

    return let(F.lower(text), lambda low: let_all({"yes": terms_present(low, yes), "no": terms_present(low, no)}, judge))


def list_items(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?m)^\s*[•\-\*]\s+")) + F.regexp_count(text, F.lit(r"(?m)^\s*\d+\.\s+"))


def classify_complexity(text: Column, terms=COMPLEX_TERMS) -> Column:
    def judge(s: Column) -> Column:
        n, score = s["n"], s["score"]
        return first_match([((n > 400) & (score >= 3), "complex"), ((n > 200) & (score >= 1), "medium")], "simple")

    score = let(F.lower(text), lambda low: terms_present(low, terms)) + list_items(text) * 0.5
    return let_all({"n": word_count(text), "score": score}, judge)


def best_class(scores: Sequence[tuple[str, Column]], default: str, at_least: int = 1) -> Column:
    """Name with the highest score, the first one on equal scores, ``default`` below ``at_least``."""
    def pick(s: Column) -> Column:
        top = F.array_max(F.transform(s, lambda x: x["score"]))
        named = F.filter(s, lambda x: x["score"] == top)[0]["name"]
        return F.when(top >= at_least, named).otherwise(default)

    return let(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("long").alias("score")) for n, c in scores]), pick)


def classify_industry(text: Column, lexicon=INDUSTRY_TERMS) -> Column:
    return let(F.lower(text), lambda low: best_class([(name, terms_present(low, terms)) for name, terms in lexicon], "other"))


def length_class(text: Column) -> Column:
    return let(word_count(text), lambda n: first_match([(n < 500, "simple"), (n < 1500, "medium")], "complex"))


def first_industry(text: Column, lexicon=INDUSTRY_TERMS, hits: int = 2) -> Column:
    """The first industry with enough of its terms."""
    return let(F.lower(text), lambda low: first_match(
        [(terms_present(low, terms) >= hits, name) for name, terms in lexicon], "general"))


def industry_by_occurrence(text: Column, lexicon=INDUSTRY_TERMS) -> Column:
    """Struct of the industry with the most occurrences of its terms, and whether that rests on fewer than three."""
    def judge(scores: Column) -> Column:
        named = best_class([(name, scores[name]) for name, _ in lexicon], "general")
        return F.struct(named.alias("industry"), (F.greatest(*[scores[name] for name, _ in lexicon]) < 3).alias("low_confidence"))

    return let(F.lower(text), lambda low: let_all({name: term_occurrences(low, terms) for name, terms in lexicon}, judge))


def four_factor_complexity(text: Column, legal=LEGAL_TERMS, money=FINANCIAL_TERMS) -> Column:
    n = F.length(text)
    stops = n - F.length(F.translate(text, ".\n", ""))
    terms = let(F.lower(text), lambda low: terms_present(low, legal) + F.when(terms_present(low, money) >= 3, 1).otherwise(0))
    score = first_match([(n > 10000, 2), (n > 5000, 1)], 0) + terms + F.when(stops > 100, 1).otherwise(0)
    return let(score, lambda s: first_match([(s >= 4, "complex"), (s >= 2, "medium")], "simple"))


def sentence_lengths(text: Column) -> Column:
    """Words per non-blank sentence."""
    parts = F.filter(F.split(text, P.SENTENCE_END, -1), lambda s: strip(s) != "")
    return F.transform(parts, word_count)


def mean_sentence_length(text: Column) -> Column:
    mean = let(sentence_lengths(text), lambda n: F.try_divide(
        F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a + x).cast("double"), F.size(n).cast("double")))
    return F.coalesce(mean, F.lit(0.0))


def complexity_score3(text: Column, formal=P.FORMAL_WORDS) -> Column:
    """Points for sentence length, clauses per sentence and formal words per thousand."""
    def grade(x: Column, mid: float, high: float) -> Column:
        return first_match([(x > high, 3), (x > mid, 2)], 1)

    def judge(s: Column) -> Column:
        count = F.size(s["lengths"])
        mean = F.try_divide(F.aggregate(s["lengths"], F.lit(0).cast("long"), lambda a, x: a + x).cast("double"), count.cast("double"))
        clauses = F.try_divide(s["marks"].cast("double"), count.cast("double"))
        share = F.try_divide(s["formal"] * 1000.0, s["words"].cast("double"))
        score = let_all({"m": mean, "c": clauses, "f": share}, lambda x: grade(x["m"], 20, 30) + grade(x["c"], 0.15, 0.3) + grade(x["f"], 2, 5))
        level = let(score, lambda x: first_match([(x >= 8, "complex"), (x >= 5, "medium")], "simple"))
        return F.when(count == 0, "simple").otherwise(level)

    return let_all({
        "lengths": sentence_lengths(text), "marks": F.length(text) - F.length(F.translate(text, ",;", "")),
        "formal": let(F.lower(text), lambda low: terms_present(low, formal)), "words": word_count(text)}, judge)


def style_detect(text: Column, formal=P.FORMAL_WORDS, casual=P.CASUAL_WORDS) -> Column:
    bullets = F.lit(0)
    for pattern in P.BULLET_LINES:
        bullets = bullets + F.regexp_count(text, F.lit(pattern))
    return let(F.lower(text), lambda low: first_match(
        [(bullets > 2, "bullets"), (terms_present(low, formal) > terms_present(low, casual), "formal")], "casual"))


def style_profile(text: Column, formal=P.FORMAL_WORDS, casual=P.CASUAL_WORDS) -> Column:
    """Struct of tone counts, formality and clause density."""
    def judge(s: Column) -> Column:
        f, c, mean = s["formal"], s["casual"], s["mean"]
        ratio = f / (f + c + 1)
        formality = ratio * 0.5 + F.least(mean / 30, F.lit(1.0)) * 0.3 + F.least(s["passive"] / 10, F.lit(1.0)) * 0.2
        return F.struct(
            f.cast("long").alias("formal_count"), c.cast("long").alias("casual_count"), ratio.alias("formal_ratio"),
            F.when(f > c, "formal").otherwise("casual").alias("dominant_tone"), mean.alias("mean_sentence_length"),
            formality.alias("formality"), (s["clauses"] / F.greatest(s["words"], F.lit(1))).alias("clause_density"))

    count = lambda terms: let(F.lower(text), lambda low: terms_present(low, terms))
    return let_all({
        "formal": count(formal), "casual": count(casual), "mean": mean_sentence_length(text),
        "passive": F.regexp_count(text, F.lit("(?U)" + P.PASSIVE)), "clauses": F.regexp_count(text, F.lit("[,;]")),
        "words": word_count(text)}, judge)


def sentence_structures(text: Column, first: int = 20, legal=P.FORMAL_WORDS) -> Column:
    """Length, clause mark, subject start and legal words of the first sentences longer than ten characters."""
    heads = F.filter(F.transform(F.slice(F.split(text, P.SENTENCE_END, -1), 1, first), strip), lambda s: F.length(s) > 10)

    def describe(s: Column) -> Column:
        head = F.regexp_extract(s, P.WORD_RUN, 0)
        legal_hit = F.lit(False)
        for term in legal:
            legal_hit = legal_hit | F.lower(s).contains(term)
        return F.struct(
            word_count(s).alias("length"), s.contains(",").alias("has_clause"),
            (F.lower(head).isin(*P.SUBJECT_WORDS) | head.rlike(r"^\p{Lu}")).alias("starts_with_subject"),
            legal_hit.alias("legal"))

    return F.transform(heads, describe)


def coherence_rules(
    text: Column, strong=STRONG_POSITIVE, moderate=MODERATE_POSITIVE, platform=PLATFORM_TERMS,
    strong_neg=STRONG_NEGATIVE, moderate_neg=MODERATE_NEGATIVE,
) -> Column:
    """Keyword score of an agreement text in [0, 1]."""
    def judge(s: Column) -> Column:
        plus, minus, n = s["plus"], s["minus"], s["n"]
        base = first_match([
            ((plus >= 3) & (minus == 0), 0.75), ((plus >= 2) & (minus <= 1), 0.65), ((plus >= 1) & (minus <= 2), 0.55),
            (minus >= 3, 0.2), (minus >= 1, 0.4)], 0.5)
        factor = first_match([(n < 50, 0.8), (n > 300, 1.1)], 1.0)
        return F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), base * factor)))

    return let(F.lower(F.coalesce(text, F.lit(""))), lambda low: let_all({
        "plus": 2 * terms_present(low, strong) + terms_present(low, moderate) + terms_present(low, platform),
        "minus": 3 * terms_present(low, strong_neg) + terms_present(low, moderate_neg), "n": word_count(low)}, judge))


def fragments(text: Column, skips=P.FRAGMENT_SKIPS, masks=P.FRAGMENT_MASKS) -> Column:
    """Reusable sentences of five words or more, without anything specific, durations and counts masked."""
    specific = "|".join(f"(?:{p})" for p in skips)
    kept = F.filter(F.transform(F.split(text, P.SENTENCE_END, -1), strip),
                    lambda s: (word_count(s) >= 5) & ~s.rlike("(?U)" + specific))

    def mask(s: Column) -> Column:
        for pattern, name in masks:
            s = F.regexp_replace(s, "(?U)" + pattern, name)
        return s

    return F.filter(F.transform(kept, mask), lambda s: word_count(s) >= 3)


def text_style(text: Column, casual=("hey", "mate", "reckon", "budget", "around")) -> Column:
    """The simpler variant: bullet marks or many dashes, casual words, else formal."""
    low, hit = F.lower(text), F.lit(False)
    for word in casual:
        hit = hit | low.contains(word)
    dashes = F.length(text) - F.length(F.replace(text, F.lit("-"), F.lit("")))
    return first_match([(text.contains("•") | (dashes > 3), "bullet_points"), (hit, "casual")], "formal")


def keyword_style(text: Column, table, default: str) -> Column:
    """The first style with any of its words in the text."""
    low = F.lower(text)
    return first_match([(terms_present(low, terms) > 0, name) for name, terms in table], default)


# fixed values
LEVEL_CONFIDENCE = {"simple": 0.85, "medium": 0.72, "complex": 0.58}
STYLE_CONFIDENCE = {
    "formal_brief": 0.1, "bullet_points": 0.05, "contract_summary": 0.08,
    "brief_sms": -0.15, "conversational_pitch": -0.08, "casual_email": -0.05,
}
NOISE_WORDS = ("TBC", "approx", "arnd", "delivs", "budgt")


def confidence_score(
    text: Column, level: Column, style: Column, noise: Sequence[str] = NOISE_WORDS, gaps: Sequence[str] = ("...", "TBC"),
    base=LEVEL_CONFIDENCE, styles=STYLE_CONFIDENCE,
) -> Column:
    """Base by level and style, less for noise words, gaps and short texts, within [0.3, 0.95]."""
    gap = F.lit(False)
    for mark in gaps:
        gap = gap | text.contains(mark)
    noisy = F.lower(text).rlike(r"(?U)\b(?:" + "|".join(noise) + r")\b")
    score = (
        first_match([(level == k, v) for k, v in base.items()], 0.72)
        + first_match([(style == k, v) for k, v in styles.items()], 0.0)
        - F.when(noisy, 0.1).otherwise(0.0) - F.when(gap, 0.08).otherwise(0.0)
        - F.when(word_count(text) < 20, 0.05).otherwise(0.0)
    )
    return F.greatest(F.lit(0.3), F.least(F.lit(0.95), score))


def completeness(fields: Column, required=("influencer", "brand", "fee", "deliverables")) -> Column:
    """complete, partial (up to two required fields missing) or minimal."""
    missing = F.lit(0)
    for name in required:
        missing = missing + F.when(F.coalesce(F.try_element_at(fields, F.lit(name)), F.lit("")).isin("", "TBC"), 1).otherwise(0)
    return first_match([(missing == 0, "complete"), (missing <= 2, "partial")], "minimal")


def route_class(sentence: Column, anchors: Sequence[tuple[str, Sequence[str], Sequence[str]]], default: str) -> Column:
    """Class with the most points, one per keyword and two per pattern; the later of equal classes, none gives the default."""
    low = F.lower(sentence)
    scores = [(name, terms_present(low, words) + 2 * terms_present(low, marks)) for name, words, marks in reversed(anchors)]
    return best_class(scores, default)


def threshold_class(best: Column, best_score: Column, second_score: Column, default: str, threshold: float = 0.3,
                    floor: float = 0.1, gap: float = 0.05) -> Column:
    """The best class unless its score is too low or too close to the second."""
    unsure = (best_score < floor) | (best_score - F.coalesce(second_score, F.lit(-1.0)) < gap) | (best_score < threshold)
    return F.when(unsure, default).otherwise(best)


def coherence_from_similarity(max_good: Column, mean_good: Column, max_bad: Column, mean_bad: Column) -> Column:
    raw = 0.4 * max_good + 0.3 * mean_good - (0.2 * max_bad + 0.1 * mean_bad) + 0.3
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))
