"""Operator 13: the cheapest repair of a conversation's structure, by weighted CYK over spans of turns.

Roles of a sound conversation spell ``(s?(ua)+)?`` by their initials. The grammar that may repair is in Chomsky
normal form: a nonterminal (p, q) spells what takes the role automaton from state p to state q,

    (p, q) -> (p, r) (r, q)        for all states p, r, q
    (p, q) -> row                  keep, rerole or delete it, at the row's costs
    (p, q) -> nothing              by inserting roles that lead from p to q, three apiece

and a cell holds, for each (p, q), the least (cost, audit) of a span of rows, the audit being the edits'
initials. Cells of one row are closed under insertion on both sides; longer spans are combined bottom-up by
length, 1, 2, 4 and so on. A split of a span at any row gives the same cell, as every string that leads from
p to q can be cut anywhere, so one split a span is enough: n - 1 products in place of the n**3 / 6 of a general
grammar. Least audits may be kept cell by cell: of two audits of one span with one cost, neither begins the
other (the longer one would have more insertions and thus cost more), so what follows cannot turn their order.

Rows are sorted and cut by range of (conv_id, turn, content), so one conversation may lie in many tasks. A task
reduces the rows of a conversation in a batch to one cell, which also carries the counts; cells of conversations
that go over the edge of a batch are combined in order. Rows travel there without texts. The repaired texts are
hashed in a second pass, in order and row by row.

Defined results: a null role or text is one space, and so is a null conv_id or turn in the digest that chooses
the damage. Rows without conv_id are one conversation. Rows of one turn come in the order of the digest of role
and text, rows equal in all that one after the other. Every conv_id returns; one without rows after the damage
has zeros, an empty audit and the digest of the empty text. Empty tables give no rows. Other columns are not
read. A conversation's audit is one string and must fit a worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loomset.llm.tables import bounded_batches, joined_by_key, parts_for, written_table

#: states of the role automaton: nothing yet, after s, after u, after a; the first and the last may end
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ENDS = (START, AFTER_A)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: rows that one task sorts and parses
TASK_ROWS = 1 << 18

Cell = dict[tuple[int, int], tuple[int, str]]


def product(left: Cell, right: Cell) -> Cell:
    """The least (cost, audit) of two adjacent spans for every pair of states."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            more = right.get((r, q))
            if more is not None:
                made = (cost + more[0], audit + more[1])
                if (p, q) not in out or made < out[p, q]:
                    out[p, q] = made
    return out


def _insertions() -> Cell:
    """The insertion closure: the fewest inserted roles from state to state."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for _ in range(3):
        for (p, r), (cost, audit) in list(cell.items()):
            for role in ROLES:
                q = STEP.get((r, role))
                if q is not None:
                    made = (cost + INSERT, audit + "I")
                    if (p, q) not in cell or made < cell[p, q]:
                        cell[p, q] = made
    return cell


CLOSURE = _insertions()
_rows: dict[tuple[str, bool, bool], Cell] = {}


def row_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The closed cell of one row."""
    key = initial if initial in ("s", "u", "a") else "", must_go, truncated
    if key not in _rows:
        cell: Cell = {(p, p): (DELETE, "D") for p in range(4)}
        if not must_go:
            more = TRUNCATED if truncated else 0
            for (p, role), q in STEP.items():
                options = [(more, "K")] if role == initial else []
                options += [(REROLE + more, "R")] if role in ROLES else []
                if options:
                    cell[p, q] = min([*options, cell[p, q]] if (p, q) in cell else options)
        _rows[key] = product(product(CLOSURE, cell), CLOSURE)
    return _rows[key]


def combined(cells: list[Cell]) -> Cell:
    """The cell of the whole span: adjacent spans are combined until one is left, shortest first."""
    while len(cells) > 1:
        paired = [product(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = paired + cells[len(paired) * 2 :]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the best repair of a whole conversation."""
    return min(cell[START, q] for q in ENDS if (START, q) in cell)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct_turns")
_CELL = "cost array<bigint>, audit array<string>, head string, tail string, first_turn bigint, last_turn bigint, " + ", ".join(
    f"{n} bigint" for n in _COUNTS
)
_PAIRS = [(p, q) for p in range(4) for q in range(4)]


class Span:
    """Adjacent rows of one conversation: their cell, their counts, and what their neighbours need to know."""

    __slots__ = ("cells", "head", "tail", "first_turn", "last_turn", "counts")

    def __init__(self):
        self.cells, self.head, self.tail, self.first_turn, self.last_turn = [], None, None, None, None
        self.counts = dict.fromkeys(_COUNTS, 0)

    def _next(self, head: str, tail: str, first, last) -> None:
        if self.head is None:
            self.head, self.first_turn = head, first
        else:
            self.counts["illegal"] += self.tail + head not in ("su", "ua", "au")
            # distinct turns are counted on both sides of the seam
            self.counts["distinct_turns"] -= first is not None and first == self.last_turn
        if self.first_turn is None:
            self.first_turn = first
        self.tail = tail
        if last is not None:
            if self.first_turn is None:
                self.first_turn = last
            self.last_turn = last

    def add_row(self, initial: str, turn, blank: bool, repeated: bool, truncated: bool, copies: int) -> None:
        """``copies`` equal rows, of which all but the first are duplicates."""
        self._next(initial, initial, turn, turn)
        self.counts["distinct_turns"] += turn is not None
        self.counts["illegal"] += copies - 1
        first = not (blank or repeated)
        self.counts["blank"] += copies if blank else 0
        self.counts["duplicate"] += 0 if blank else copies - first
        self.counts["truncated"] += first and truncated
        self.cells.append(row_cell(initial, not first, truncated))
        if copies > 1:
            gone = {(p, p): (DELETE * (copies - 1), "D" * (copies - 1)) for p in range(4)}
            self.cells.append(product(gone, CLOSURE))

    def add_span(self, record: dict) -> None:
        self._next(record["head"], record["tail"], record["first_turn"], record["last_turn"])
        for name in _COUNTS:
            self.counts[name] += record[name]
        self.cells.append({k: (c, a) for k, c, a in zip(_PAIRS, record["cost"], record["audit"]) if c is not None})

    def record(self) -> dict:
        cell = combined(self.cells)
        return {
            "cost": [cell.get(k, (None, None))[0] for k in _PAIRS], "audit": [cell.get(k, (None, None))[1] for k in _PAIRS],
            "head": self.head, "tail": self.tail, "first_turn": self.first_turn, "last_turn": self.last_turn, **self.counts,
        }


def _columns(names: list[str], records: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], schema.field(n).type) for n in names], schema=schema)


def _arrow(conv: pa.DataType) -> pa.Schema:
    kinds = {"cost": pa.list_(pa.int64()), "audit": pa.list_(pa.string()), "head": pa.string(), "tail": pa.string()}
    names = ["cost", "audit", "head", "tail", "first_turn", "last_turn", *_COUNTS]
    return pa.schema([pa.field("conv_id", conv), pa.field("place", pa.int64())] + [pa.field(n, kinds.get(n, pa.int64())) for n in names])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the conversations of each batch; ``place`` counts them in the order of this task."""
    place = 0
    for batch in batches:
        records, span, at = [], None, None
        column = {n: batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "blank", "truncated", "repeated", "copies")}
        for conv, turn, initial, blank, cut, repeated, copies in zip(*column.values()):
            if span is None or conv != at:
                if span is not None:
                    records.append({"conv_id": at, "place": place, **span.record()})
                    place += 1
                span, at = Span(), conv
            span.add_row(initial, turn, blank, repeated, cut, copies)
        if span is not None:
            records.append({"conv_id": at, "place": place, **span.record()})
            place += 1
        schema = _arrow(batch.schema.field("conv_id").type)
        yield _columns(schema.names, records, schema)


def _merge(table: pa.Table) -> pa.Table:
    """One conversation's spans in order, as one."""
    records = sorted(table.to_pylist(), key=lambda r: (r["task"], r["place"]))
    span = Span()
    for record in records:
        span.add_span(record)
    schema = _arrow(table.schema.field("conv_id").type)
    made = {"conv_id": records[0]["conv_id"], "place": 0, **span.record()}
    return pa.Table.from_batches([_columns(schema.names, [made], schema)])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for record in batch.to_pylist():
            cell = {k: (c, a) for k, c, a in zip(_PAIRS, record["cost"], record["audit"]) if c is not None}
            cost, audit = cheapest(cell)
            first, last = record["first_turn"], record["last_turn"]
            gaps = 0 if first is None else last - first + 1 - record["distinct_turns"]
            gaps = (gaps + (1 << 63)) % (1 << 64) - (1 << 63)
            out.append({**record, "gaps": gaps, "cost": cost, "audit": audit})
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id")] + [pa.array([r[n] for r in out], pa.string() if n == "audit" else pa.int64()) for n in _PARSED],
            names=["conv_id", *_PARSED],
        )


_PARSED = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after the damage that crc32 of ``conv_id:turn`` modulo 20 chooses."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("bigint").alias("turn"), said("role").alias("role"), said("text").alias("text"), kind.alias("kind")
    ).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _content():
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def facts(rows: DataFrame) -> DataFrame:
    """Without texts: each different (conv_id, turn, role, text), how many rows it stands for, and their faults."""
    inked = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    kept = rows.select(
        "conv_id", "turn", _content().alias("content"), F.substring("role", 1, 1).alias("initial"), (inked == "").alias("blank"),
        (~F.right(inked, F.lit(1)).isin(".", "!", "?")).alias("truncated"), "copies",
    )
    once = kept.groupBy("conv_id", "turn", "content", "initial", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    once = written_table(once, "facts")
    # of equal rows in several turns all but those of the first turn are duplicates
    several = once.groupBy("conv_id", "content").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("first")
    ).where("n > 1")
    joined = joined_by_key(
        once.withColumn("conv", F.struct("conv_id")),
        written_table(several.select(F.struct("conv_id").alias("conv"), "content", "first", "n", F.lit(True).alias("several")), "several"),
        ["conv", "content"], "n",
    )
    repeated = F.coalesce(F.col("several"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))
    return joined.select("conv_id", "turn", "content", "initial", "blank", "truncated", "copies", repeated.alias("repeated"))


def parsed(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of the damaged ``rows``."""
    spark = rows.sparkSession
    bounded_batches(spark)
    known = written_table(facts(rows), "facts")
    parts = parts_for(spark, known.count(), TASK_ROWS)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("content")]
    sorted_ = known.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    conv = rows.schema["conv_id"].dataType.simpleString()
    cells = sorted_.mapInArrow(_parse, f"conv_id {conv}, place bigint, {_CELL}").withColumn("task", F.spark_partition_id())
    cells = written_table(cells, "spans").withColumn("conv", F.struct("conv_id"))
    cut = cells.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select("conv")
    whole = cells.join(cut, "conv", "left_anti").drop("task", "conv")
    pieces = cells.join(cut, "conv", "left_semi").drop("conv")
    merged = pieces.groupBy("conv_id").applyInArrow(_merge, f"conv_id {conv}, place bigint, {_CELL}")
    kinds = ", ".join(f"{n} {'string' if n == 'audit' else 'bigint'}" for n in _PARSED)
    return whole.unionByName(merged).mapInArrow(_finish, f"conv_id {conv}, {kinds}")


class _Digest:
    """Repaired rows of one conversation, hashed as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.made = audit, 0, 0
        self.offset = sum(e != "D" for e in audit) % 2
        self.hash = hashlib.sha256()

    def put(self, role: str, text: str) -> None:
        if self.made:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode())
        self.made += 1

    def _wanted(self) -> str:
        return "ua"[(self.made - self.offset) % 2]

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(ROLES[self._wanted()], "")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self.put(role if edit == "K" else ROLES[self._wanted()], text)


class _Open:
    """The conversation that a sorted stream is at: its id, what the parse found, and its digest."""

    def __init__(self, conv):
        self.conv, self.found, self.digest = conv, [0] * (len(_PARSED) - 1) + [""], _Digest("")

    def closed(self) -> tuple:
        self.digest.inserted()
        return self.conv, *self.found, self.digest.hash.hexdigest()


def _digests(conv_type: pa.DataType):
    kinds = [conv_type] + [pa.string() if n == "audit" else pa.int64() for n in _PARSED] + [pa.string()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["conv_id", *_PARSED, "repaired_sha256"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A conversation comes as its marker, what the parse found, if it has rows, and its rows in order."""
        now = None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "tag", "role", "text", "copies", *_PARSED)]
            for conv, tag, role, text, copies, *found in zip(*columns):
                if tag == 0:
                    if now is not None:
                        done.append(now.closed())
                    now = _Open(conv)
                elif tag == 1:
                    now.found, now.digest = found, _Digest(found[-1])
                else:
                    now.digest.row(role, text, copies)
            if done:
                yield out(done)
        if now is not None:
            yield out([now.closed()])

    return each


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conv_id."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    rows = damaged(conversations)
    found = written_table(parsed(rows), "parsed")
    none = lambda names, kind: [F.lit(None).cast(kind).alias(n) for n in names]
    markers = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("tag"), *none(["turn"], "bigint"), *none(["content"], "binary"), *none(["role", "text"], "string"),
        *none(["copies", *_PARSED[:-1]], "bigint"), *none(["audit"], "string"),
    )
    parses = found.select(
        "conv_id", F.lit(1).alias("tag"), *none(["turn"], "bigint"), *none(["content"], "binary"), *none(["role", "text"], "string"),
        *none(["copies"], "bigint"), *_PARSED,
    )
    told = rows.select(
        "conv_id", F.lit(2).alias("tag"), "turn", _content().alias("content"), "role", "text", "copies",
        *none(_PARSED[:-1], "bigint"), *none(["audit"], "string"),
    )
    order = [F.col("conv_id"), F.col("tag"), F.col("turn").asc_nulls_first(), F.col("content")]
    parts = parts_for(spark, found.count(), TASK_ROWS)
    stream = markers.unionByName(parses).unionByName(told).repartition(parts, "conv_id").sortWithinPartitions(*order)
    kind = conversations.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} {'string' if n == 'audit' else 'bigint'}" for n in _PARSED)
    return stream.mapInArrow(_digests(to_arrow_type(kind)), f"{schema}, repaired_sha256 string")
