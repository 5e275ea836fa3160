"""Dataset statistics. Every report is an aggregate with map-side combine; ties break on the value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.session import written_table

from .ranking import exact_rank, prefix_sum

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
EXACT = "decimal(38,0)"


def facet_counts(df: DataFrame, facets: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, facet, value, n): the counts of several columns in one pass and one shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(f).alias("facet"), F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias("value")) for f in facets
    ])
    long = df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.facet", "p.value")
    return long.groupBy(*by, "facet", "value").agg(F.count("*").alias("n"))


#: values of one group that a task may sort; above it a group's ranks are bracketed by counts first
SORTED_IN_TASK = 1 << 17
#: cuts of one round of brackets; a round leaves about four in as many of the values
_CUTS = 256


def exact_percentiles(
    df: DataFrame, value: str, points: dict[str, float], by: Sequence[str] = (), in_task: int = SORTED_IN_TASK
) -> DataFrame:
    """Interpolated percentiles of a column of numbers, exactly, without one place for all values of a group.

    Each point needs the values at two ranks. In a group of more than ``in_task`` values a rank gets a bracket
    between two approximate quantiles; counting what lies below, on and between its ends proves that the rank
    is there, and rounds go on inside until ``in_task`` values or a single one are left. Only the brackets are
    then sorted, each in one task. Nulls and NaN do not count; a group of nothing else has no row.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(group.alias("g"), number.alias("v"))
    whole = rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    whole = written_table(whole, "groups")
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("bigint") for p in points.values() for f in (F.floor, F.ceil)]))
    state = written_table(whole.select(
        "g", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("inside"),
        F.lit(False).alias("between"), F.lit(False).alias("final"),
    ), "ranks")
    large = (F.col("inside") > in_task) & (F.col("lo") < F.col("hi")) & ~F.col("final")
    while not state.where(large).isEmpty():
        state = written_table(state.where(~large).unionByName(_narrowed(rows, state.where(large))), "ranks")
    counted = _held(rows, state).groupBy("g", "rank", "below", "v").agg(F.count("*").alias("c"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy("g", "rank").orderBy("v"))
    found = counted.withColumn("upto", upto).where(F.col("upto") > F.col("rank")).groupBy("g", "rank").agg(F.min("v").alias("v"))
    values = found.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("values"))

    def made(p: float) -> Column:
        low, high = (F.col("values")[f(place(p)).cast("bigint")] for f in (F.floor, F.ceil))
        return low + (high - low) * (place(p) - F.floor(place(p)))

    return whole.join(values, "g").select(*[F.col(f"g.{c}").alias(c) for c in by], *[made(p).alias(name) for name, p in points.items()])


def _held(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows in the brackets of their group's ranks."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    return rows.join(state, "g").where(F.when(F.col("between"), (v > lo) & (v < hi)).otherwise((v >= lo) & (v <= hi)))


def _narrowed(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The state with smaller brackets."""
    grid = F.percentile_approx("v", [i / _CUTS for i in range(_CUTS + 1)], 100 * _CUTS)
    cuts = _held(rows, state).groupBy("g", "rank").agg(grid.alias("cuts"))
    at = (F.col("rank") - F.col("below")) / F.col("inside") * _CUTS
    aimed = state.join(cuts, ["g", "rank"]).withColumn("low", F.get("cuts", F.greatest(F.floor(at) - 1, F.lit(0)).cast("int"))).withColumn(
        "high", F.get("cuts", F.least(F.ceil(at) + 1, F.lit(_CUTS)).cast("int"))).drop("cuts")
    aimed = written_table(aimed, "brackets")
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    held = _held(rows, aimed).groupBy("g", "rank").agg(
        F.count_if(v < low).alias("less"), F.count_if(v == low).alias("on_low"), F.count_if((v > low) & (v < high)).alias("inner"),
        F.count_if((v == high) & (high > low)).alias("on_high"))
    rank, first = F.col("rank"), F.col("below") + F.col("less")
    inner, after = first + F.col("on_low"), first + F.col("on_low") + F.col("inner")
    where = (
        F.when((rank >= first) & (rank < inner), "low").when((rank >= inner) & (rank < after), "between")
        .when((rank >= after) & (rank < after + F.col("on_high")), "high")
    )
    pick = lambda low, between, high, lost: (
        F.when(F.col("where") == "low", low).when(F.col("where") == "between", between).when(F.col("where") == "high", high).otherwise(lost))
    return aimed.join(held, ["g", "rank"]).withColumn("where", where).select(
        "g", "rank", pick(low, low, high, F.col("lo")).alias("lo"), pick(low, high, high, F.col("hi")).alias("hi"),
        pick(first, inner, after, F.col("below")).alias("below"),
        pick(F.col("on_low"), F.col("inner"), F.col("on_high"), F.col("inside")).alias("inside"),
        pick(F.lit(False), F.lit(True), F.lit(False), F.col("between")).alias("between"),
        # a rank that the approximate quantiles missed is looked up among all that its old bracket holds
        F.col("where").isNull().alias("final"),
    )


def length_stats(df: DataFrame, value: str, by: Sequence[str] = (), sample_std: bool = False) -> DataFrame:
    """Count, mean, median, deviation, extremes and quartiles of an integer column.

    Sums run over value counts in exact arithmetic, so the result does not depend
    on the order of the rows.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("long").alias("v")).agg(
        F.count("*").alias("c"))
    v, c = F.col("v").cast(EXACT), F.col("c").cast(EXACT)
    points = F.array(*[F.lit(p) for p in QUARTILES.values()])
    out = counted.groupBy(*by).agg(
        F.sum("c").alias("n"), F.sum((v * c).cast(EXACT)).cast("double").alias("s1"),
        F.sum((v * v * c).cast(EXACT)).cast("double").alias("s2"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.percentile(F.col("v"), points, F.col("c")).alias("p"),
    )
    spread = F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.lit(0.0))
    std = F.sqrt(F.try_divide(spread, F.col("n") - (1 if sample_std else 0)))
    return out.select(
        *by, "n", (F.col("s1") / F.col("n")).alias("mean"), std.alias("std"), "min", "max",
        *[F.col("p")[i].alias(name) for i, name in enumerate(QUARTILES)],
    )


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the extremes; the last one includes the maximum. Empty bins have a count of 0."""
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    width = (high - low) / F.lit(float(bins))
    place = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)))
    filled = df.groupBy(place.cast("long").alias("bin")).agg(
        F.count("*").alias("n"), F.min(value).alias("lowest"), F.max(value).alias("highest"))
    return df.sparkSession.range(bins).toDF("bin").join(filled, "bin", "left").fillna(0, ["n"])


def combo(labels: Column, sep: str = "|", empty: str = "") -> Column:
    return F.when(F.size(labels) > 0, F.array_join(F.array_sort(labels), sep)).otherwise(empty)


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of row value by column value, zero where nothing was seen."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def with_shares(counts: DataFrame, n: str = "n", out: str = "share") -> DataFrame:
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(out, F.try_divide(F.col(n).cast("double"), total.cast("double")))


def pair_counts(df: DataFrame, id_: str, items: str, ordered: bool = False) -> DataFrame:
    """How often two items occur in the same row's array. ``ordered`` keeps both orders and the diagonal."""
    distinct = F.array_distinct(F.col(items))
    both = df.select(distinct.alias("x")).select(F.explode("x").alias("first"), "x").select(
        "first", F.explode("x").alias("second"))
    both = both if ordered else both.where("first < second")
    return both.groupBy("first", "second").agg(F.count("*").alias("n"))


def jaccard_of_sets(df: DataFrame, item: str, split: str, names: Sequence[str]) -> DataFrame:
    """For every two splits: items in both, items in either, and their ratio."""
    marks = df.groupBy(item).agg(*[F.bool_or(F.col(split) == s).alias(s) for s in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    counts = marks.agg(
        *[F.count_if(F.col(a) & F.col(b)).alias(f"both_{a}_{b}") for a, b in pairs],
        *[F.count_if(F.col(a) | F.col(b)).alias(f"any_{a}_{b}") for a, b in pairs],
    )
    rows = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"both_{a}_{b}").alias("shared"), F.col(f"any_{a}_{b}").alias("total"))
        for a, b in pairs
    ])
    return counts.select(F.inline(rows)).withColumn(
        "jaccard", F.coalesce(F.try_divide(F.col("shared").cast("double"), F.col("total").cast("double")), F.lit(0.0)))


def quality_metrics(df: DataFrame, by: str, score: str, flags: dict[str, Column]) -> DataFrame:
    """Per group: mean, median, population deviation and extremes of a score, and the percentage of each flag."""
    shares = [F.round(100.0 * F.avg(flag.cast("int")), 4).alias(f"{name}_percent") for name, flag in flags.items()]
    whole = df.groupBy(by).agg(
        F.round(F.avg(score), 6).alias("mean"), F.round(F.stddev_pop(score), 6).alias("std"), F.min(score).alias("min"),
        F.max(score).alias("max"), *shares,
    )
    middle = exact_percentiles(df, score, {"median": 0.5}, [by]).withColumnRenamed(by, "__by")
    return whole.join(middle, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")


def batch_metadata(df: DataFrame, batch: str, facets: Sequence[str], fee: str, tokens: str, ood: Column, coherent: Column) -> DataFrame:
    """Rows (batch, n, ood, coherent, token_*, min_fee, max_fee, section, key, in_key) of every batch.

    A batch has one row for each class of each facet and for each bracket of its positive fees, "<1k" or "3k".
    Counts are combined before the shuffle; a batch without a positive fee has the rows of its classes.
    """
    amount = F.col(fee)
    bracket = F.when(amount >= 1000, F.concat(F.floor(amount / 1000).cast("bigint").cast("string"), F.lit("k"))).when(amount > 0, "<1k")
    counted = facet_counts(df.withColumn("fee_bracket", bracket).withColumn("__has_fee", bracket.isNotNull()), [*facets, "fee_bracket"], [batch, "__has_fee"])
    counted = counted.where((F.col("facet") != "fee_bracket") | F.col("__has_fee")).groupBy(batch, "facet", "value").agg(F.sum("n").alias("in_key"))
    t = F.col(tokens)
    whole = df.groupBy(batch).agg(
        F.count("*").alias("n"), F.count_if(ood).alias("ood"), F.count_if(coherent).alias("coherent"),
        F.round(F.avg(t), 6).alias("token_mean"), F.min(t).alias("token_min"), F.max(t).alias("token_max"), F.round(F.stddev_pop(t), 4).alias("token_std"),
        F.min(F.when(amount > 0, amount)).alias("min_fee"), F.max(F.when(amount > 0, amount)).alias("max_fee"),
    )
    return whole.join(counted.withColumnsRenamed({"facet": "section", "value": "key"}), batch)


def group_majority(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows (group, size, value): the most common value, the smallest on equal counts."""
    counted = df.groupBy(group, value).agg(F.count("*").alias("c"))
    return counted.groupBy(group).agg(
        F.sum("c").alias("size"), F.min_by(value, F.struct(-F.col("c"), F.col(value))).alias(value))


def label_profile(df: DataFrame, doc: str, label: str) -> DataFrame:
    """Rows (doc, profile): shares of every label rounded to two places, joined as a key."""
    counted = df.groupBy(doc, label).agg(F.count("*").alias("c"))
    total = F.sum("c").over(Window.partitionBy(doc))
    part = F.format_string("%s:%.2f", F.col(label), F.round(F.col("c") / total, 2))
    return counted.select(doc, part.alias("part")).groupBy(doc).agg(
        F.array_join(F.array_sort(F.collect_list("part")), "|").alias("profile"))


def balance_scores(df: DataFrame, targets: DataFrame) -> DataFrame:
    """Mean over the targets of 1 - |actual - target| per facet.

    ``df(facet, value)`` holds one row per observation, ``targets(facet, value,
    target)``; a target class without rows counts as zero.
    """
    counted = df.groupBy("facet", "value").agg(F.count("*").alias("c"))
    total = counted.groupBy("facet").agg(F.sum("c").alias("total"))
    joined = targets.join(total, "facet", "left").join(counted, ["facet", "value"], "left")
    actual = F.coalesce(F.try_divide(F.col("c").cast("double"), F.col("total").cast("double")), F.lit(0.0))
    score = F.when(F.col("total").isNull(), 0.0).otherwise(1 - F.abs(actual - F.col("target")))
    return joined.groupBy("facet").agg(F.avg(score).alias("balance"))


def upper_median(df: DataFrame, value: str, width: float = 1000.0) -> DataFrame:
    """One row with the element at position n // 2 of the sorted values: of two middle values the upper.

    The running count over the distinct values goes stretch by stretch of ``width``, so no task sorts them all.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("c"))
    middle = F.floor(counted.agg(F.sum("c")).scalar() / 2)
    running = prefix_sum(counted, F.col("c"), [value], F.floor(F.col(value) / width), name="before")
    return running.where((F.col("before") <= middle) & (F.col("before") + F.col("c") > middle)).select(
        F.col(value).alias("median"))


def classification_report(pairs: DataFrame, gold: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class and their plain mean; undefined ratios are zero."""
    cells = pairs.groupBy(F.col(gold).alias("g"), F.col(pred).alias("p")).agg(F.count("*").alias("c"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("g").alias("label"), F.col("c").alias("support"), F.lit(0).cast("long").alias("guessed"),
                 F.when(F.col("g") == F.col("p"), F.col("c")).otherwise(0).alias("right")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("c").alias("guessed"),
                 F.lit(0).cast("long").alias("right")),
    )).alias("s")).select("s.*")
    per = sides.groupBy("label").agg(F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("right").alias("right"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    scored = per.withColumn("precision", ratio(F.col("right"), F.col("guessed"))).withColumn(
        "recall", ratio(F.col("right"), F.col("support")))
    scored = scored.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    cols = ("precision", "recall", "f1")
    classes = scored.select(F.col("label").cast("string").alias("label"), *cols, "support")
    macro = classes.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in cols], F.sum("support").alias("support"))
    return classes.unionByName(macro)


def inverse_freq_weight(df: DataFrame, combo_: str) -> DataFrame:
    """Rows (combo, n, weight) with weight = rows / (n * number of combos)."""
    counted = df.groupBy(combo_).agg(F.count("*").alias("n"))
    rows, combos = counted.agg(F.sum("n")).scalar(), counted.agg(F.count("*")).scalar()
    return counted.withColumn("weight", rows.cast("double") / (F.col("n") * combos))


def apply_thresholds(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Flags of a long table (metric, key, value) by rules (metric, side, bound, flag)."""
    broken = F.when(F.col("side") == "above", F.col("value") > F.col("bound")).otherwise(F.col("value") < F.col("bound"))
    return metrics.join(rules, "metric").where(broken).select("flag", "metric", "key", "value")


def long_rows(df: DataFrame, metric: str) -> DataFrame:
    """Rows (metric, key, value): one per column of a one-row table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in df.columns])
    return df.select(F.lit(metric).alias("metric"), F.inline(pairs))


def weighted_sample(df: DataFrame, id_: str, weight: str, unit: Column, n: int) -> DataFrame:
    """``n`` rows without replacement, each drawn in proportion to its weight: the smallest -ln(u) / w."""
    return df.withColumn("draw", -F.log(unit) / F.col(weight)).orderBy("draw", id_).limit(n)


def rolling_mean(
    df: DataFrame, key: str, order: Sequence[str], value: str, bucket: Column, n: int = 10, block_rows: int = 100_000
) -> DataFrame:
    """Mean of the last ``n`` values of the key, zero until there are ``n``.

    A key's rows are cut into blocks by their rank; the last rows of a block are
    also given to the next one as context. So a hot key is many tasks.
    """
    ranked = exact_rank(df, order, bucket, [key], "rank").withColumn("block", F.floor((F.col("rank") - 1) / block_rows))
    ahead = F.floor((F.col("rank") - 1 + (n - 1)) / block_rows)
    spread = ranked.withColumn("into", F.explode(F.array_distinct(F.array("block", ahead))))
    frame = Window.partitionBy(key, "into").orderBy("rank").rowsBetween(-(n - 1), 0)
    mean = F.when(F.col("rank") >= n, F.avg(value).over(frame)).otherwise(0.0)
    return spread.withColumn("recent_mean", mean).where(F.col("into") == F.col("block")).drop("block", "into")
