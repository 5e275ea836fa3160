"""Ranks, running totals and top-k that hold up when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.session import written_table


def digest(id_: Column, seed: int | str = 42) -> Column:
    """The portable pseudo-random order of a row: md5 of seed and id."""
    return F.md5(F.concat(F.lit(f"{seed}|"), id_.cast("string")))


def digest_bucket(hashed: Column, digits: int = 3) -> Column:
    """Leading hex digits of a digest: evenly filled buckets that keep its order."""
    return F.substring(hashed, 1, digits)


def range_bucket(df: DataFrame, value: str, rows_each: int = 1 << 20) -> Column:
    """Evenly filled buckets that keep the order of ``value``, however its values are spread.

    The driver gets one cut for every ``rows_each`` rows, at least one.
    """
    parts = max(2, -(-df.count() // rows_each))
    cuts = df.agg(F.percentile_approx(value, [i / parts for i in range(1, parts)])).first()[0]
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col(value)))


def prefix_sum(
    df: DataFrame, value: Column, order: Sequence[str | Column], bucket: Column,
    keys: Sequence[str] = (), name: str = "before",
) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows of the key, the row itself excluded.

    ``bucket`` cuts each key's order into pieces and must not fall along it. A
    task sorts one piece; the totals of the pieces, one short row each, carry
    the offset. So neither a global order nor a hot key ends up in one task.
    """
    rows = df.withColumn("__bucket", bucket).withColumn("__value", value.cast("long"))
    totals = rows.groupBy(*keys, "__bucket").agg(F.sum("__value").alias("__total"))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "__bucket", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("__inside", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
        .join(offsets, [*keys, "__bucket"])
        .withColumn(name, F.col("__inside") + F.col("__offset"))
        .drop("__bucket", "__value", "__inside", "__offset")
    )


def exact_rank(
    df: DataFrame, order: Sequence[str | Column], bucket: Column, keys: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """1-based rank inside each key, computed piece by piece as in :func:`prefix_sum`."""
    return prefix_sum(df, F.lit(1), order, bucket, keys, name).withColumn(name, F.col(name) + 1)


def dense_numbers(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Numbers 1, 2, 3, ... in the order of any sortable columns, ascending with nulls first unless said, equal rows in some order.

    Rows are dealt by range and sorted, then written once with their task and their place in it, so that
    numbers cannot change when a task is repeated. The counts of the tasks, one short row each, give the
    offsets. Rows of one value may lie in several tasks.
    """
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order, "__row").sortWithinPartitions(*order, "__row")
    # the upper bits of the id are the task, the lower 33 the row in it
    placed = written_table(dealt.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    task, place = F.shiftright("__row", 33), F.col("__row").bitwiseAND((1 << 33) - 1)
    placed = placed.withColumn("__task", task)
    counts = placed.groupBy("__task").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__task", before.alias("__before"))
    return placed.join(offsets, "__task").withColumn(name, F.col("__before") + place + 1).drop("__task", "__row", "__before")


def seeded_rank(
    df: DataFrame, id_: str, seed: int | str = 42, keys: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Rank in the seeded order of the ids; the same after any re-partitioning."""
    hashed = df.withColumn("__digest", digest(F.col(id_), seed))
    ranked = exact_rank(hashed, ["__digest", id_], digest_bucket(F.col("__digest")), keys, name)
    return ranked.drop("__digest")


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of every key. Spark keeps at most ``n`` per key before the shuffle."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return ranked.where(F.col(name) <= n)


def top_k_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; equal counts by value."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), F.col(key).asc()).limit(k)


def recent_n(df: DataFrame, ts: str, id_: str, n: int) -> DataFrame:
    return df.orderBy(F.col(ts).desc(), F.col(id_).desc()).limit(n)


def page(df: DataFrame, order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """One page of rows with the total and the next offset, null on the last page.

    Reading a page this way costs offset + limit rows; see :func:`page_after` for
    deep pages of large tables.
    """
    total = df.agg(F.count("*")).scalar()
    rows = df.orderBy(*order).offset(offset).limit(limit).withColumn("total", total)
    more = F.lit(offset + limit) < F.col("total")
    return rows.withColumn("next_offset", F.when(more, F.lit(offset + limit).cast("long")))


def page_after(df: DataFrame, ts: str, id_: str, after_ts: Column, after_id: Column, limit: int) -> DataFrame:
    """The page that follows a known last row; the bound is pushed into the scan."""
    later = (F.col(ts) > after_ts) | ((F.col(ts) == after_ts) & (F.col(id_) > after_id))
    return df.where((F.col(ts) >= after_ts) & later).orderBy(ts, id_).limit(limit)
