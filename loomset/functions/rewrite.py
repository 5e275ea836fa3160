"""Rewriting, augmentation and masking. Every random choice is a digest of seed, id and place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .chunks import CUT
from .text import UNI, let, strip, word_count

# fixed values, applied in order
TO_CASUAL = ((r"\bshall\b", "will"), (r"\bpursuant to\b", "according to"), (r"\bhereby\b", ""), (r"\bwhereas\b", "since"))
TO_FORMAL = ((r"\bcan't\b", "cannot"), (r"\bwon't\b", "will not"), (r"\blet's\b", "let us"))
FILLERS = ((r"\b(?:very|quite|really|extremely|absolutely)\s+", ""), (r"\b(?:and|or)\s+", ", "), (r"\s+", " "))
CLEARER = (("innovative", "creative"), ("comprehensive", "complete"), ("strategic", "focused"), ("leverage", "use"), ("optimize", "improve"))
SYNONYMS = (
    ("enhance", "improve"), ("drive", "boost"), ("create", "develop"), ("deliver", "provide"), ("campaign", "initiative"),
    ("engagement", "collaboration"), ("authentic", "genuine"), ("strategic", "targeted"),
)


def replace_words(text: Column, table: Sequence[tuple[str, str]]) -> Column:
    """Whole words by the table, in order, whatever their case."""
    for word, other in table:
        text = F.regexp_replace(text, rf"(?iU)\b{word}\b", other)
    return text


def replace_first_word(text: Column, table: Sequence[tuple[str, str]]) -> Column:
    """Only the first word of the table that occurs in the text is replaced."""
    low, out = F.lower(text), None
    for word, other in table:
        case = (low.contains(word), F.regexp_replace(text, rf"(?iU)\b{word}\b", other))
        out = F.when(*case) if out is None else out.when(*case)
    return text if out is None else out.otherwise(text)


def apply_patterns(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    for pattern, other in rules:
        text = F.regexp_replace(text, UNI + pattern, other)
    return text


def to_bullets(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, P.SENTENCE_END, -1), strip), lambda s: word_count(s) >= 3)
    return F.array_join(F.transform(parts, lambda s: F.concat(F.lit("• "), s)), "\n")


def rewrite(text: Column, style: Column, casual=TO_CASUAL, formal=TO_FORMAL) -> Column:
    """Bullets, casual or formal wording, as ``style`` says for the row."""
    return (
        F.when(style == "bullets", to_bullets(text)).when(style == "casual", apply_patterns(text, casual))
        .otherwise(apply_patterns(text, formal))
    )


def draw(id_: Column, purpose: str, seed: int = 42) -> Column:
    """A number in [0, 1) for one choice on one row."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), id_.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(1 << 32)


def seeded_order(items: Column, id_: Column) -> Column:
    """Items in the order of the digest of id and item; equal items by their place."""
    keyed = F.transform(items, lambda x, i: F.struct(
        F.md5(F.concat_ws("|", id_.cast("string"), x)).alias("h"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def augment(text: Column, id_: Column, synonyms, typos, note: str, p_typo: float = 0.2, p_note: float = 0.3,
            p_breaks: float = 0.15, seed: int = 42) -> dict[str, Column]:
    """Variants of a text: sentences reordered, words swapped, and a messy one with typos, a note and line breaks."""
    swapped, messy = text, text
    for word, other in synonyms:
        swapped = F.replace(swapped, F.lit(word), F.lit(other))
    for word, other in typos:
        messy = F.replace(messy, F.lit(word), F.lit(other))
    messy = F.when(draw(id_, "typo", seed) < p_typo, messy).otherwise(text)
    messy = F.concat(messy, F.when(draw(id_, "note", seed) < p_note, F.lit(note)).otherwise(""))
    messy = let(messy, lambda m: F.when(
        draw(id_, "breaks", seed) < p_breaks, F.replace(m, F.lit("."), F.lit(".\n"))).otherwise(m))
    reordered = F.array_join(seeded_order(F.split(text, r"\. ", -1), id_), ". ")
    return {"reordered": reordered, "swapped": swapped, "messy": messy}


def token_dropout(text: Column, id_: Column, share: float = 0.125, mask: str = "[MASK]") -> Column:
    """Mask a share of the tokens, at least one; texts of up to two tokens stay as they are."""
    def keys(toks: Column) -> Column:
        # the digest, then the place in digits of one length: as strings in the order of (digest, place)
        return let(F.coalesce(F.concat(id_.cast("string"), F.lit("|")), F.lit("")), lambda name: F.transform(toks, lambda _, i: F.concat(
            F.md5(F.concat(name, i.cast("string"))), F.lpad(i.cast("string"), 10, "0"))))

    def drop(toks: Column) -> Column:
        count = F.greatest(F.lit(1), F.floor(F.size(toks) * share).cast("int"))
        # the tokens up to the count-th smallest key are masked
        masked = let(keys(toks), lambda ks: let(F.element_at(F.sort_array(ks), count), lambda last: F.zip_with(
            toks, ks, lambda t, k: F.when(k <= last, mask).otherwise(t))))
        # a space only between two words; a mask or a mark starts and ends with no word character.
        # The cut comes first in the pattern, so that only there it is looked behind
        joined = F.regexp_replace(F.array_join(masked, CUT), rf"{CUT}(?<={P.W}{CUT})(?={P.W})", " ")
        return F.replace(joined, F.lit(CUT), F.lit(""))

    # a word or one other mark, plain letters and spaces decided first
    cut = F.regexp_extract_all(
        text, F.lit(rf"(?! )(?:[A-Za-z]++{P.W}*+|{P.W}++|[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}])"), F.lit(0))
    return let(cut, lambda toks: F.when(F.size(toks) <= 2, text).otherwise(drop(toks)))
