"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

All signature coordinates come from two permutations of the 32-bit numbers: the first places a
shingle, the second is applied once for each coordinate with the places shifted circularly by one
more. Documents with equal shingle sets are one class from the start, named by its smallest
doc_id. In a bucket of classes that agree on a band, a few hubs are compared with all others instead
of all pairs; rounds go on until every bucket holds one component, or all of its pairs between
components have been compared. So no link that joins two components is lost, and a group of many
near copies costs about as many comparisons as it has members. Before the sets of a pair are fetched,
their sizes and the bitmaps of their shingles must allow the similarity, which loses nothing, and the
low bits of their signatures must not differ too often.

Defined cases: a null, empty or wordless text has an empty set and links with nothing; a row without
an id is its own component (null); repeated rows of an id are one document; a text of fewer words
than a shingle has its whole word sequence as its one shingle; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomset.llm.flat import NOT_SPACE, Texts, lowered, mixed, ragged_range, slices, texts_of, word_hashes, words_of
from loomset.llm.links import classes
from loomset.llm.tables import text_rows, written_table

#: 40 bands of 6 coordinates miss a pair at 0.8 with a chance of 5e-6
BANDS, BAND_ROWS = 40, 6
#: of 128 signature bits a pair at 0.8 differs in 13 on average, in more than 36 with a chance below 1e-8
SKETCH_BITS, SKETCH_APART = 128, 36
#: bits of the bitmap of a set: bits that differ never outnumber shingles that differ
MAP_BITS = 1024
_CHUNK = 1 << 15


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each row, ascending, and their ranges."""
    words = words_of(texts, NOT_SPACE)
    value = word_hashes(texts, words)
    count = np.diff(words.first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at = ragged_range(words.first[:-1], n)
    row = np.repeat(np.arange(len(n)), n)
    # a text of fewer words is one shingle of that many words
    until = words.first[1:][row]
    hashed = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = at + k < until
        word = value[np.where(inside, at + k, 0)] if len(value) else hashed
        hashed = np.where(inside, mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + word), hashed)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashed[1:] != hashed[:-1])
    return hashed[new], np.searchsorted(row[new], np.arange(len(n) + 1))


def _second_permutation(x: np.ndarray) -> np.ndarray:
    """A bijection of 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x21F0AAAD)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x735A2D97)
    x ^= x >> np.uint32(15)
    return x


def signatures(hashed: np.ndarray, first: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation, its circle turned k places."""
    full = np.flatnonzero(np.diff(first) > 0)
    out = np.full((len(first) - 1, coordinates), 0xFFFFFFFF, np.uint32)
    place = (mixed(hashed) >> np.uint64(32)).astype(np.uint32)
    at = 0
    while at < len(full):
        # rows whose numbers stay in the cache together; a longer row is taken in parts
        to = max(at + 1, int(np.searchsorted(first[full + 1], first[full[at]] + _CHUNK, "right")))
        rows = full[at:to]
        end = int(first[rows[-1] + 1])
        step = _CHUNK if len(rows) == 1 else end
        for low in range(int(first[rows[0]]), end, step):
            part = place[low : min(low + step, end)]
            begins = first[rows] - low if len(rows) > 1 else np.zeros(1, np.int64)
            least = [np.minimum.reduceat(_second_permutation(part - np.uint32(k)), begins) for k in range(coordinates)]
            out[rows] = np.minimum(out[rows], np.stack(least, axis=1))
        at = to
    return out


_SIGNED = "doc_id bigint, n_shingles bigint, set_hash bigint, set_check bigint, bands array<bigint>, bits array<bigint>, map array<bigint>"


def _lists(table: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)), pa.array(table.ravel()))


def _sign(width: int, bands: int, rows: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed, first = shingle_sets(lowered(texts_of(part.column("text"))), width)
            signature = signatures(hashed, first, max(bands * rows, SKETCH_BITS))
            bits = np.packbits((signature[:, :SKETCH_BITS] & 1).astype(bool), axis=1).view(np.int64)
            coordinates = signature[:, : bands * rows].astype(np.uint64).reshape(len(first) - 1, bands, rows)
            band = np.zeros(coordinates.shape[:2], np.uint64)
            for k in range(rows):
                band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, :, k] + np.uint64(1))
            shown = np.zeros((len(first) - 1, MAP_BITS), bool)
            shown[np.repeat(np.arange(len(first) - 1), np.diff(first)), (hashed % np.uint64(MAP_BITS)).astype(np.int64)] = True
            sums = np.zeros((2, len(hashed) + 1), np.uint64)
            np.cumsum(mixed(hashed), out=sums[0, 1:])
            np.cumsum(mixed(hashed ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
            sums = (sums[:, first[1:]] - sums[:, first[:-1]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.diff(first)), pa.array(sums[0]), pa.array(sums[1]),
                    _lists(band.astype(np.int64)), _lists(bits),
                    _lists(np.packbits(shown, axis=1).view(np.int64)),
                ],
                names=["doc_id", "n_shingles", "set_hash", "set_check", "bands", "bits", "map"],
            )

    return each


def _list_sets(width: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashed, first = shingle_sets(lowered(texts_of(part.column("text"))), width)
            sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashed.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sets], names=["id", "shingles"])

    return each


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * |intersection| >= threshold * |union|, on full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right_set"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left_set", "right_set")).cast("bigint")
    union = F.size("left_set") + F.size("right_set") - common
    return both.where(100 * common >= threshold * union).select("a", "b")


def _apart(name: str, bits: int):
    """In how many bits the columns ``name`` and ``other_name`` differ."""
    words = (F.get(name, F.lit(k)).bitwiseXOR(F.get(f"other_{name}", F.lit(k))) for k in range(bits // 64))
    return sum((F.bit_count(w) for w in words), F.lit(0))


def _may_be_near(threshold: int):
    """Whether two classes may be similar enough: exact on sizes and bitmaps, safe on signature bits."""
    sizes = 100 * F.least("n", "other_n") >= threshold * F.greatest("n", "other_n")
    maps = (100 + threshold) * _apart("map", MAP_BITS) <= (100 - threshold) * (F.col("n") + F.col("other_n"))
    return sizes & (_apart("bits", SKETCH_BITS) <= SKETCH_APART) & maps


def near_duplicate_classes(
    docs: DataFrame, width: int = 5, threshold: int = 80, bands: int = BANDS, band_rows: int = BAND_ROWS, hubs: int = 256
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row.

    Two documents are linked if the Jaccard similarity of their shingle sets is ``threshold`` percent
    or more; component_id is the smallest doc_id reachable by links.
    """
    rows = text_rows(docs)
    signed = written_table(rows.mapInArrow(_sign(width, bands, band_rows), _SIGNED), "signatures")
    same = ["set_hash", "set_check", "n_shingles"]
    sets_of = (
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same)
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.any_value("bands").alias("bands"),
             F.any_value("bits").alias("bits"), F.any_value("map").alias("map"))
    )
    sets_of = written_table(sets_of, "classes")
    in_bands = sets_of.select(F.posexplode("bands").alias("band", "key"), F.col("first_id").alias("id"))
    # buckets of several classes, and the smallest id of each
    several = in_bands.groupBy("band", "key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub < top")
    members = written_table(in_bands.join(several.drop("top"), ["band", "key"]), "buckets")
    sets = rows.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = written_table(sets.mapInArrow(_list_sets(width), "id bigint, shingles array<bigint>"), "sets")

    near = _may_be_near(threshold)
    facts = sets_of.select(F.col("first_id").alias("id"), F.col("n_shingles").alias("n"), "bits", "map")
    other_facts = facts.select(*(F.col(c).alias(f"other_{c}") for c in facts.columns))
    compared = members.where("id > hub").select(F.col("hub").alias("other_id"), "id").distinct()
    compared = compared.join(other_facts, "other_id").join(facts, "id").where(near)
    compared = written_table(compared.select(F.col("other_id").alias("a"), F.col("id").alias("b")), "pairs")
    links = written_table(_verified(compared, sets, threshold), "near")
    component = classes(links)
    hubs_done = members.where("id = hub").select("band", "key", "id")
    while True:
        # buckets whose members are in several components; those outside the largest are the next hubs
        now = members.join(component, "id", "left").select(
            "band", "key", "id", F.coalesce("component", "id").alias("component")
        )
        sizes = now.groupBy("band", "key", "component").agg(F.count("*").alias("size"))
        open_buckets = sizes.groupBy("band", "key").agg(
            F.max_by("component", F.struct("size", "component")).alias("largest"), F.count("*").alias("several")
        ).where("several > 1").drop("several")
        now = written_table(now.join(open_buckets, ["band", "key"]).join(facts, "id"), "open")
        waiting = now.where("component <> largest").join(hubs_done, ["band", "key", "id"], "left_anti")
        order = Window.partitionBy("band", "key").orderBy("id")
        picked = written_table(waiting.withColumn("at", F.row_number().over(order)).where(F.col("at") <= hubs).drop("at", "largest"), "hubs")
        if picked.isEmpty():
            break
        hubs *= 4
        hubs_done = hubs_done.unionByName(picked.select("band", "key", "id"))
        other = now.select("band", "key", *(F.col(c).alias(f"other_{c}") for c in ("id", "n", "bits", "map", "component")))
        pairs = (
            picked.join(other, ["band", "key"]).where((F.col("component") != F.col("other_component")) & near)
            .select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct()
            .join(compared, ["a", "b"], "left_anti")
        )
        pairs = written_table(pairs, "pairs")
        compared = compared.unionByName(pairs)
        more = written_table(_verified(pairs, sets, threshold), "near")
        if not more.isEmpty():
            links = links.unionByName(more)
            component = classes(links)

    # only classes of several documents, or in a component with others, have anything to say
    moved = sets_of.join(component, sets_of.first_id == component.id, "left").select(
        *same, F.coalesce("component", "first_id").alias("component"), "first_id", "last_id"
    ).where("component <> first_id OR first_id <> last_id").select(*same, "component")
    found = signed.join(moved, same, "left")
    component_id = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(
        F.coalesce("component", "doc_id")
    )
    return found.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id, with all columns."""
    gone = near_duplicate_classes(docs, **settings).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
