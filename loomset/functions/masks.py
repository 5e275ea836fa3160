"""Patterns of a text: numbers, money, durations and names masked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import words

# fixed values, applied in this order
MASKS = (
    (r"\d+", "<NUM>"),
    (r"\$<NUM>[,<NUM>]*", "<MONEY>"),
    (r"<NUM>\s*(?:week|month|year)s?", "<DURATION>"),
)
PROPER = r"^\p{Lu}.*[\p{Ll}\p{Lt}]"


def mask_pattern(text: Column) -> Column:
    for pattern, name in MASKS:
        text = F.regexp_replace(text, pattern, name)
    return F.array_join(
        F.transform(words(text), lambda w: F.when(w.rlike(PROPER), "<PROPER_NOUN>").otherwise(F.lower(w))), " ")
