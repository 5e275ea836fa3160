"""Labels from fields, patterns and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .rules import first_match
from .text import UNI, words

# fixed values
VALID_LABELS = (
    "client", "brand", "campaign", "fee", "deliverables", "exclusivity_period", "exclusivity_scope",
    "engagement_term", "usage_term", "territory",
)
LABEL_LIMITS = {"minimal": (1, 3), "moderate": (3, 6), "complex": (5, 9), "comprehensive": (7, 12)}
SUB_LABEL_PATTERNS = (
    ("brand_name", (r"\b\w+(?=\s+campaign|\s+brand)", r"for\s+(\w+)", r"(\w+)\s+-\s+\$")),
    ("brand_type", (r"restaurant|fashion|tech|beauty|fitness|food|retail",)),
    ("content_type", (r"instagram|facebook|twitter|tiktok|youtube|photo|video|post|story|reel",)),
    ("content_count", (r"\d+\s*x\s*", r"\d+\s+(?:post|story|reel|photo|video)")),
    ("budget_amount", (r"\$[\d,]+", r"budget.*?\$[\d,]+")),
    ("duration_weeks", (r"\d+\s*w(?:eek)?", r"\d+\s*week")),
    ("duration_months", (r"\d+\s*m(?:onth)?", r"\d+\s*month")),
    ("usage_duration", (r"usage.*?\d+\s*month", r"rights.*?\d+\s*month")),
    ("exclusivity_duration", (r"exclusivity.*?\d+\s*week", r"\d+\s*week\s*exclusivity")),
)
CONTENT_PATTERNS = (
    ("instagram_post", (r"instagram\s+post", r"ig\s+post")),
    ("instagram_story", (r"instagram\s+story", r"ig\s+story")),
    ("instagram_reel", (r"instagram\s+reel", r"ig\s+reel")),
    ("facebook_post", (r"facebook\s+post", r"fb\s+post")),
    ("facebook_story", (r"facebook\s+story", r"fb\s+story")),
    ("twitter_post", (r"twitter\s+post", r"tweet")),
    ("tiktok_video", (r"tiktok", r"tt\s+video")),
    ("youtube_video", (r"youtube", r"yt\s+video")),
    ("photo", (r"photo", r"image", r"picture")),
    ("video", (r"video", r"clip", r"footage")),
    ("lifestyle", (r"lifestyle", r"casual", r"everyday")),
    ("product_focused", (r"product", r"showcase", r"feature")),
)


def key_phrases_of(value: Column) -> Column:
    """What counts as a mention of a field value: itself, its words, its phrase, platform aliases, amounts."""
    low = F.lower(value)
    parts = words(F.regexp_replace(low, rf"[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}]", " "))
    single = F.filter(parts, lambda w: (F.length(w) > 2) & ~w.rlike(r"^\p{N}+$"))
    none = F.array().cast("array<string>")
    found = [F.array(low), single, F.when(F.size(parts) > 1, F.array(F.array_join(parts, " "))).otherwise(none)]
    for mark, aliases in P.FIELD_ALIASES:
        found.append(F.when(low.contains(mark), F.array(*[F.lit(a) for a in aliases])).otherwise(none))
    found.append(F.when(low.contains("$"), F.regexp_extract_all(low, F.lit(r"\d+"), F.lit(0))).otherwise(none))
    return F.flatten(F.array(*found))


def label_by_field_match(text: Column, fields: Column, valid: Sequence[str] = VALID_LABELS) -> Column:
    """Sorted names of the fields (name -> values) with a value mentioned in the text."""
    low = F.lower(text)
    hits = F.map_filter(fields, lambda name, values: name.isin(*valid) & F.exists(
        F.filter(values, lambda v: v != ""), lambda v: F.exists(key_phrases_of(v), lambda p: low.contains(p))))
    return F.array_sort(F.map_keys(hits))


def labels_by_patterns(text: Column, table: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Names whose patterns occur in the lower-cased text, in table order."""
    low = F.lower(text)
    return F.array_compact(F.array(*[
        F.when(low.rlike(UNI + "|".join(f"(?:{p})" for p in found)), name) for name, found in table]))


def pad_labels(labels: Column, level: Column, pool: Sequence[str], id_: Column, limits=LABEL_LIMITS) -> Column:
    """Between the bounds of the level: missing labels come from the pool, surplus ones go, both in seeded order."""
    shuffled = lambda a: F.transform(
        F.array_sort(F.transform(a, lambda x: F.struct(F.md5(F.concat_ws("|", id_.cast("string"), x)).alias("h"), x.alias("x")))),
        lambda s: s["x"])
    low = first_match([(level == k, v[0]) for k, v in limits.items()], 3)
    high = first_match([(level == k, v[1]) for k, v in limits.items()], 6)
    own = F.array_distinct(labels)
    spare = shuffled(F.array_except(F.array(*[F.lit(p) for p in pool]), own))
    more = F.concat(own, F.slice(spare, F.lit(1), F.greatest(low - F.size(own), F.lit(0))))
    less = F.slice(shuffled(own), F.lit(1), high)
    return F.array_sort(F.when(F.size(own) > high, less).otherwise(more))


def label_count_range(n: Column) -> Column:
    return first_match([(n <= 2, "1-2"), (n <= 4, "3-4"), (n <= 6, "5-6"), (n <= 8, "7-8")], "9+")


def sample_type(is_distractor: Column, is_multi_label: Column) -> Column:
    return first_match([(F.coalesce(is_distractor, F.lit(False)), "distractor"),
                        (F.coalesce(is_multi_label, F.lit(False)), "multi_label")], "original")


def labels_from_fields(fields: Column, names: dict[str, str]) -> Column:
    """Mapped names of the fields that hold something, sorted."""
    told = F.map_filter(fields, lambda k, v: F.coalesce(v, F.lit("")) != "")
    return F.array_sort(F.array_compact(F.array(*[
        F.when(F.array_contains(F.map_keys(told), field), label) for field, label in names.items()])))
