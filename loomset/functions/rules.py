"""Named rules as (name, Column) pairs, evaluated together in one projection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


class RuleBook:
    """Named predicates that a caller extends; a row's issues are the names that hold."""

    def __init__(self, rules: Iterable[Rule] = ()):
        self.rules: list[Rule] = list(rules)

    def register(self, name: str, broken: Column) -> "RuleBook":
        if any(n == name for n, _ in self.rules):
            raise ValueError(f"rule {name} is registered twice")
        self.rules.append((name, broken))
        return self

    def issues(self) -> Column:
        return issues(self.rules)


def issues(rules: Iterable[Rule]) -> Column:
    """Names of the rules whose condition holds; a null condition does not hold."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def joined(names: Column) -> Column:
    return F.array_join(names, "|")


def first_match(cases: Iterable[tuple[Column, object]], default: object) -> Column:
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(default) if out is None else out.otherwise(default)


def terms_present(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms occur as substrings. For short lexicons; a long one joins on tokens."""
    total = F.lit(0)
    for term in terms:
        total = total + F.when(text.contains(term), 1).otherwise(0)
    return total


def term_occurrences(text: Column, terms: Iterable[str]) -> Column:
    """Sum of non-overlapping occurrences of the terms."""
    total = F.lit(0)
    for term in terms:
        rest = F.length(F.replace(text, F.lit(term), F.lit("")))
        total = total + ((F.length(text) - rest) / len(term)).cast("int")
    return total


# severities of one document sample; section names are fixed values
SECTIONS = ("full", "header", "body", "footer")


def document_sample_rules(
    path: Column, doc_id: Column, section: Column, text: Column,
    char_len: Column, tok_len: Column, chunks: Column, needs_chunking: Column,
) -> list[Rule]:
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    return [
        ("source_path", blank(path)),
        ("doc_id", blank(doc_id)),
        ("section", ~section.isin(*SECTIONS)),
        ("text", blank(text)),
        ("char_len", char_len != F.length(text)),
        ("tok_len", tok_len <= 0),
        ("chunks", needs_chunking & (F.size(chunks) <= 1)),
    ]
