"""Sentences, clauses and token-bounded chunks as folds over arrays.

A fold only decides where chunks start; texts are joined once afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import est_tokens_words, let, strip, word_count, words

CUT = "␟"
TOKENS_PER_WORD = 1.33


def _pieces(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def sentences_at_capitals(text: Column) -> Column:
    """Cut at whitespace that follows an end mark and precedes a capital."""
    return _pieces(F.split(text, rf"(?<=[.!?]){P.WS}+(?=[A-Z])", -1))


def sentences_at_marks(text: Column) -> Column:
    """Cut at runs of end marks, which are dropped."""
    return _pieces(F.split(text, P.SENTENCE_END, -1))


def split_clauses(sentence: Column, breaks=P.CLAUSE_BREAKS) -> Column:
    """Clauses keep their delimiter; one of fewer than three words joins the clause before it."""
    marked = sentence
    for pattern in breaks:
        marked = F.regexp_replace(marked, f"({pattern})", f"$1{CUT}")
    none = F.array().cast("array<string>")

    def merge(done: Column, clause: Column) -> Column:
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                          F.array(F.concat_ws(" ", F.element_at(done, -1), clause)))
        return F.when((word_count(clause) >= 3) | (F.size(done) == 0), F.concat(done, F.array(clause))).otherwise(longer)

    return F.aggregate(_pieces(F.split(marked, CUT, -1)), none, merge)


def word_windows(text: Column, max_tokens: int) -> Column:
    """Stretches of words whose estimate stays within ``max_tokens``."""
    size = max(1, int(max_tokens / TOKENS_PER_WORD))
    return let(words(text), lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / size).cast("int") - 1, F.lit(0))),
        lambda i: F.array_join(F.slice(w, i * size + 1, F.lit(size)), " ")))


def starts(costs: Column, fits) -> Column:
    """1-based positions where a chunk starts. ``fits(load, cost)`` gives the new load, or null when it is too much."""
    state = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).cast("long").alias("load"), F.lit(0).alias("i"))

    def step(s: Column, cost: Column) -> Column:
        load = fits(s["load"], cost)
        opens = (s["i"] == 0) | load.isNull()
        return F.struct(
            F.when(opens, F.concat(s["at"], F.array(s["i"] + 1))).otherwise(s["at"]).alias("at"),
            F.when(opens, cost).otherwise(load).cast("long").alias("load"), (s["i"] + 1).alias("i"))

    return F.aggregate(costs, state, step, lambda s: s["at"])


def join_from(pieces: Column, at: Column) -> Column:
    """Chunks of ``pieces`` that start at the given positions."""
    def chunk(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.try_element_at(at, k + 2), F.size(pieces) + 1)
        return F.array_join(F.slice(pieces, start, stop - start), " ")

    return F.transform(at, chunk)


def pack(pieces: Column, cost, fits) -> Column:
    """Join neighbouring pieces while ``fits`` allows."""
    def packed(ps: Column) -> Column:
        return let(starts(F.transform(ps, cost), fits), lambda at: join_from(ps, at))

    return let(pieces, packed)


def bounded_pieces(sentences: Column, max_tokens: int, breaks=P.CLAUSE_BREAKS) -> Column:
    """Sentences; a too long one as clauses, a too long clause as word windows, in document order."""
    def clause(c: Column) -> Column:
        return F.when(est_tokens_words(c) <= max_tokens, F.array(c)).otherwise(word_windows(c, max_tokens))

    def sentence(s: Column) -> Column:
        smaller = F.flatten(F.transform(split_clauses(s, breaks), clause)) if breaks else word_windows(s, max_tokens)
        return F.when(est_tokens_words(s) <= max_tokens, F.array(s)).otherwise(smaller)

    return F.flatten(F.transform(sentences, sentence))


def chunk_greedy(text: Column, max_tokens: int = 480, sentences=sentences_at_capitals, breaks=P.CLAUSE_BREAKS) -> Column:
    """One chunk if the text fits, else sentences packed until the next would exceed ``max_tokens``."""
    pieces = bounded_pieces(sentences(text), max_tokens, breaks)
    packed = pack(pieces, est_tokens_words, lambda load, cost: F.when(load + cost <= max_tokens, load + cost))
    return (
        F.when(strip(text) == "", F.array().cast("array<string>"))
        .when(est_tokens_words(text) <= max_tokens, F.array(strip(text))).otherwise(packed)
    )


def chunk_joined(text: Column, max_tokens: int = 480, min_tokens: int = 20) -> Column:
    """Sentences packed by the length of the joined text at four characters a token; small chunks are dropped."""
    def fits(load: Column, cost: Column) -> Column:
        grown = F.when(load > 0, load + 1 + cost).otherwise(cost)
        return F.when(F.floor(grown / 4) <= max_tokens, grown)

    packed = pack(sentences_at_marks(text), lambda s: F.length(s).cast("long"), fits)
    return F.filter(packed, lambda c: F.floor(F.length(c) / 4) >= min_tokens)


def valid_chunks(chunks: Column, max_tokens: int = 480) -> Column:
    return F.forall(chunks, lambda c: (est_tokens_words(c) <= max_tokens) & (F.length(strip(c)) >= 10))


def chunks_or_whole(text: Column, chunks: Column, max_tokens: int = 480) -> Column:
    return F.when(valid_chunks(chunks, max_tokens), chunks).otherwise(F.array(text))


def truncate_tokens(text: Column, max_tokens: int = 480, headroom: int = 10) -> Column:
    """Whole sentences from the start while their tokens stay within the limit less the headroom."""
    def cut(ss: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("load"), F.lit(0).alias("n"), F.lit(True).alias("open"))

        def step(s: Column, t: Column) -> Column:
            ok = s["open"] & (s["load"] + est_tokens_words(t) <= max_tokens - headroom)
            return F.struct(
                F.when(ok, s["load"] + est_tokens_words(t)).otherwise(s["load"]).alias("load"),
                F.when(ok, s["n"] + 1).otherwise(s["n"]).alias("n"), ok.alias("open"))

        kept = F.aggregate(ss, state, step, lambda s: s["n"])
        return F.concat(F.array_join(F.slice(ss, F.lit(1), kept), ". "), F.lit("."))

    return let(sentences_at_marks(text), cut)


def truncate_sections(sections: Column, max_tokens: int = 480, headroom: int = 10) -> Column:
    """Whole sections from the start within the limit; the first one always stays."""
    def cut(ss: Column) -> Column:
        state = F.struct(F.lit(0).cast("long").alias("load"), F.lit(0).alias("n"), F.lit(True).alias("open"))

        def step(s: Column, t: Column) -> Column:
            load = s["load"] + est_tokens_words(t)
            ok = s["open"] & ((s["n"] == 0) | (load <= max_tokens - headroom))
            return F.struct(F.when(ok, load).otherwise(s["load"]).alias("load"),
                            F.when(ok, s["n"] + 1).otherwise(s["n"]).alias("n"), ok.alias("open"))

        return F.slice(ss, F.lit(1), F.aggregate(ss, state, step, lambda s: s["n"]))

    return let(sections, cut)


def chunk_words(text: Column, min_words: int = 500, max_words: int = 600) -> Column:
    """Windows of ``max_words`` words; a tail shorter than ``min_words`` joins the window before it."""
    def cut(w: Column) -> Column:
        n = F.size(w)
        full = F.floor(n / max_words).cast("int")
        tail = n - full * max_words
        count = F.greatest(full + F.when(tail >= min_words, 1).otherwise(0), F.lit(1))
        return F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(
            F.slice(w, (i - 1) * max_words + 1, F.when(i == count, n).otherwise(max_words).cast("int")), " "))

    return let(F.split(text, P.WS_RUN, -1), cut)


def chunk_id(doc: Column, number: Column) -> Column:
    return F.concat(doc.cast("string"), F.lit("_c"), number.cast("string"))


# units a cut must not fall into; fixed values
UNITS = (
    r"\$\d{1,3}(?:,\d{3})*(?:\.\d{2})?",
    r"\d{1,3}(?:,\d{3})+",
    *P.DATES,
    P.PHONES[0],
    P.PHONES[1],
    P.EMAIL,
    r"https?://[^\s]+",
    r"\b\d{1,2}:\d{2}(?::\d{2})?\s*(?:[AaPp][Mm])?\b",
)


# stands for a space inside a protected unit; a private-use character no text holds
HELD = "\ue000"


def _units_pattern(addresses: bool) -> str:
    """UNITS as one pattern that decides at a character what can begin there, and looks for a word's border once.

    Alternatives that can begin with the same character stand in the order of UNITS. Without ``addresses`` no e-mail
    or web address is found, and a position that holds no digit, sign or first letter of a month is passed at once.
    """
    money, thousands, day_first, year_first, month, phone, area_phone, email, web, time = UNITS
    # all of these begin at \b; nothing shorter than the whole run can stand before the @
    name = email.replace("+@", "++@", 1)
    bordered = [day_first, year_first, "(?=(?i:[JFMASOND]))" + month, phone, *([name] if addresses else []), time]
    free = [money, thousands, area_phone, *([web] if addresses else [])]
    every = "|".join([*(f"(?:{u})" for u in free), r"\b(?:" + "|".join(f"(?:{u.replace(chr(92) + 'b', '', 1)})" for u in bordered) + ")"])
    return "(?U)" + (every if addresses else rf"(?=[\$(\d]|(?i:[JFMASOND]))(?:{every})")


_ALL_UNITS, _PLAIN_UNITS = _units_pattern(True), _units_pattern(False)


def _by_units(text: Column, make) -> Column:
    """``make`` of the pattern that finds the units of a text."""
    return F.when(text.contains("@") | text.contains("http"), make(_ALL_UNITS)).otherwise(make(_PLAIN_UNITS))


def units_of(text: Column) -> Column:
    """The units of a text in order."""
    return _by_units(text, lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def protect_units(text: Column, units: Column | None = None) -> Column:
    """Whitespace inside money, dates, phones, addresses and times becomes a stand-in no cut matches.

    ``units`` are those of :func:`units_of`, if they are known already.
    """
    gaps = _by_units(text, lambda pattern: F.split(text, pattern, -1))
    held = F.transform(units_of(text) if units is None else units, lambda u: F.regexp_replace(u, P.WS, HELD))
    return F.array_join(F.zip_with(gaps, held, lambda g, u: F.concat(g, F.coalesce(u, F.lit("")))), "")


def restore_units(text: Column) -> Column:
    return F.replace(text, F.lit(HELD), F.lit(" "))
