"""Agreement rules on orders: the order is the agreement, its lines are the deliverables, the customer's segment the industry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomset.functions import agreements as A
from loomset.functions import rules as R

from .aggregating import SQL_ORDER_ITEMS, order_items
from .registry import query, quoted, table, texts

_PLATFORMS = ("Instagram", "YouTube", "TikTok", "LinkedIn", "Pinterest", "Blog")
_FORMATS = ("Post", "Story", "Reel", "Video", "Usage note", "Exclusive post")
_INDUSTRY = {"AUTOMOBILE": "tech", "BUILDING": "home", "FURNITURE": "fashion", "HOUSEHOLD": "food", "MACHINERY": "finance"}


def _sql_any(item, words):
    return "(" + " OR ".join(f"contains({item}, {quoted(w)})" for w in words) + ")"


_SQL_KINDS = {
    "posts": "contains(d, 'post')", "videos": _sql_any("d", ("video", "igtv", "tutorial")), "reels": "contains(d, 'reel')",
    "stories": _sql_any("d", ("story", "stories")), "video_class": _sql_any("d", ("video", "igtv", "youtube")),
    "reel_class": f"NOT {_sql_any('d', ('video', 'igtv', 'youtube'))} AND {_sql_any('d', ('reel', 'tiktok'))}",
    "exclusive": "contains(d, 'exclusiv')", "usage": "contains(d, 'usage')",
}
SQL_AGREEMENTS = f"""
lines AS (SELECT l_orderkey, CAST(CAST(floor(l_quantity / 10) AS BIGINT) AS VARCHAR) || ' x ' || (['{"', '".join(_PLATFORMS)}'])[l_suppkey % 6 + 1] || ' ' || (['{"', '".join(_FORMATS)}'])[l_partkey % 6 + 1] AS item FROM lineitem),
low AS (SELECT *, lower(item) AS d FROM lines),
feats AS (SELECT l_orderkey, count(*) AS items, {', '.join(f'count(*) FILTER ({e}) AS {n}' for n, e in _SQL_KINDS.items())},
  list_filter([{', '.join(f"CASE WHEN bool_or({_sql_any('d', w)}) THEN '{n}' END" for n, w in A.PLATFORM_WORDS.items())}], lambda x: x IS NOT NULL) AS platforms FROM low GROUP BY l_orderkey),
dups AS (SELECT l_orderkey, count(*) FILTER (n > 1) AS duplicates, count(*) AS distinct_items, min(d) FILTER (n > 1) AS first_duplicate FROM (SELECT l_orderkey, d, count(*) AS n FROM low GROUP BY l_orderkey, d) GROUP BY l_orderkey),
agr AS (SELECT o_orderkey, floor(o_totalprice / 10)::BIGINT AS fee, CASE c_mktsegment {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _INDUSTRY.items())} ELSE 'other' END AS industry,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'complex' WHEN '2' THEN 'complex' WHEN '3' THEN 'medium' ELSE 'simple' END AS complexity,
  CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey % 290 AS VARCHAR) || ' weeks exclusivity' WHEN 1 THEN CAST(o_orderkey % 60 AS VARCHAR) || ' months' ELSE '' END AS exclusivity,
  CAST(o_orderkey % 70 AS VARCHAR) || ' months' AS usage_term, CAST(o_orderkey % 130 AS VARCHAR) || ' week' AS engagement,
  coalesce(items, 0) AS items, {', '.join(f'coalesce({n}, 0) AS {n}' for n in _SQL_KINDS)}, coalesce(platforms, []) AS platforms, coalesce(duplicates, 0) AS duplicates, coalesce(distinct_items, 0) AS distinct_items, first_duplicate
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN feats f ON f.l_orderkey = o_orderkey LEFT JOIN dups u ON u.l_orderkey = o_orderkey)"""


def item_lines(spark, sf):
    pick = lambda words, key: F.element_at(F.array(*[F.lit(w) for w in words]), (F.col(key) % len(words) + 1).cast("int"))
    item = F.concat(F.floor(F.col("l_quantity") / 10).cast("string"), F.lit(" x "), pick(_PLATFORMS, "l_suppkey"), F.lit(" "), pick(_FORMATS, "l_partkey"))
    return texts(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), item.alias("item"))


#: lines that one task aggregates; few are equal or of one order, so it holds nearly as many groups
_LINES = 1 << 18


def agreements(spark, sf, duplicates=False):
    """One row per order. Deliverables stay a table and are aggregated, so an order may have any number of them.

    With ``duplicates`` equal deliverables are counted as one row first, which tells what repeats in the same pass. Lines are
    dealt out before either, to as many tasks as there are lines for, because a scan's own groups grow with its file split.
    """
    lines = item_lines(spark, sf)
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-table(spark, sf, "lineitem").count() // _LINES))
    if duplicates:
        same = lines.select("o_orderkey", A.normal_item(F.col("item")).alias("d")).repartition(tasks, "o_orderkey", "d")
        equal = same.groupBy("o_orderkey", "d").agg(F.count("*").alias("items"))
        rows = equal.select("o_orderkey", "d", *[c.alias(n) for n, c in A.counted_item_flags(F.col("d"), F.col("items")).items()])
        made = A.distinct_item_aggregates("d")
    else:
        dealt = lines.repartition(tasks, "o_orderkey")
        rows = dealt.select("o_orderkey", *[c.alias(n) for n, c in A.item_flags(F.lower("item")).items()])
        made = A.item_aggregates()
    feats = rows.groupBy("o_orderkey").agg(*[c.alias(n) for n, c in made.items()])
    key, first = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1)
    text = lambda n, unit: F.concat((key % n).cast("string"), F.lit(unit))
    heads = texts(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 10).cast("long").alias("fee"),
        R.first_match([(F.col("c_mktsegment") == a, b) for a, b in _INDUSTRY.items()], "other").alias("industry"),
        R.first_match([(first.isin("1", "2"), "complex"), (first == "3", "medium")], "simple").alias("complexity"),
        F.when(key % 3 == 0, text(290, " weeks exclusivity")).when(key % 3 == 1, text(60, " months")).otherwise("").alias("exclusivity"),
        text(70, " months").alias("usage_term"), text(130, " week").alias("engagement"))
    counts = ["items", *A.KINDS, *(("duplicates", "distinct_items") if duplicates else ())]
    joined = heads.join(feats, "o_orderkey", "left").fillna(0, counts)
    return joined.withColumn("platforms", F.coalesce("platforms", F.array().cast("array<string>")))


@query("extract_duration", f"""
WITH {SQL_AGREEMENTS}, x AS (SELECT o_orderkey, coalesce(TRY_CAST(regexp_extract(exclusivity, '(\\d+)\\s*weeks?', 1) AS INTEGER), 0) AS weeks, coalesce(TRY_CAST(regexp_extract(exclusivity, '(\\d+)\\s*months?', 1) AS INTEGER), 0) AS months FROM agr)
SELECT o_orderkey, weeks, months, round(CASE WHEN weeks > 0 THEN weeks / 4.33::DOUBLE ELSE months END, 6)::DOUBLE AS term_months FROM x""")
def extract_duration(spark, sf):
    term = F.col("exclusivity")
    return agreements(spark, sf).select(
        "o_orderkey", A.weeks_in(term).alias("weeks"), A.months_in(term).alias("months"), F.round(A.term_months(term), 6).alias("term_months"))


_SQL_TIER = "CASE WHEN o_totalprice / 10 >= 15000 THEN 'premium' WHEN o_totalprice / 10 >= 5000 THEN 'high' WHEN o_totalprice / 10 >= 2000 THEN 'medium' ELSE 'basic' END"


@query("fee_tier", f"SELECT o_orderkey, {_SQL_TIER} AS tier FROM orders")
def fee_tier(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", A.fee_tier(F.col("o_totalprice") / 10).alias("tier"))


@query("usage_range", f"""
WITH t AS (SELECT o_orderkey, {_SQL_TIER} AS tier FROM orders)
SELECT o_orderkey, CASE tier WHEN 'basic' THEN 3 WHEN 'medium' THEN 6 WHEN 'high' THEN 12 ELSE 18 END AS min_months, CASE tier WHEN 'basic' THEN 12 WHEN 'medium' THEN 18 WHEN 'high' THEN 24 ELSE 36 END AS max_months FROM t""")
def usage_range(spark, sf):
    return fee_tier(spark, sf).select("o_orderkey", A.usage_range(F.col("tier")).alias("r")).select("o_orderkey", "r.*")


@query("agreement_class", f"""
WITH {SQL_ORDER_ITEMS} SELECT o_orderkey, CASE WHEN fee > 50000 THEN 'HIGH_VALUE_PARTNERSHIP' WHEN fee > 15000 THEN 'STANDARD_COLLABORATION' WHEN items > 3 THEN 'MULTI_CONTENT_CAMPAIGN' ELSE 'BASIC_INFLUENCER_AGREEMENT' END AS class FROM order_items""")
def agreement_class(spark, sf):
    return order_items(spark, sf).select("o_orderkey", A.agreement_class(F.col("fee"), F.col("items")).alias("class"))


def _sql_bracket(name):
    return "CASE complexity " + " ".join(f"WHEN '{k}' THEN {float(v[name])}::DOUBLE" for k, v in A.BRACKETS.items()) + " END"


@query("expected_fee", f"""
WITH {SQL_AGREEMENTS}, b AS (SELECT *, {_sql_bracket('low')} AS lo, {_sql_bracket('high')} AS hi, {_sql_bracket('base')} AS base FROM agr),
f AS (SELECT o_orderkey, lo, hi, floor((lo + posts * base + stories * (base * 0.3::DOUBLE) + videos * base * {_sql_bracket('video')} + reels * base * {_sql_bracket('reel')}) * CASE industry WHEN 'fashion' THEN 1.1::DOUBLE WHEN 'tech' THEN 1.3 WHEN 'home' THEN 0.9 ELSE 1.0 END) AS fee FROM b)
SELECT o_orderkey, CAST(round_even(greatest(lo, least(hi, fee)) / 50, 0) * 50 AS BIGINT) AS expected FROM f""")
def expected_fee(spark, sf):
    made = A.expected_fee(F.col("complexity"), F.col("industry"), *[F.col(c) for c in ("posts", "stories", "videos", "reels")])
    return agreements(spark, sf).select("o_orderkey", made.alias("expected"))


def _sql_issues(rules):
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {e} THEN '{n}' END" for n, e in rules) + "], lambda x: x IS NOT NULL), '|')"


_SQL_BUSINESS = [("fee_range", "fee < 50 OR fee > 100000"), ("item_count", "items = 0 OR items > 25")]


@query("rule_fee_deliverables", f"""
WITH {SQL_ORDER_ITEMS} SELECT o_orderkey, {_sql_issues(_SQL_BUSINESS)} AS issues, fee > 0 AND items > 0 AND items < greatest(1, fee // 1000) / 3 AS few_items FROM order_items""")
def rule_fee_deliverables(spark, sf):
    fee, items = F.col("fee"), F.col("items")
    return order_items(spark, sf).select(
        "o_orderkey", R.joined(R.issues(A.rule_fee_deliverables(fee, items))).alias("issues"), A.few_items_warning(fee, items).alias("few_items"))


@query("rule_fee_alignment", f"""
WITH {SQL_AGREEMENTS}, e AS (SELECT *, items * {_sql_bracket('base')} * (pow({_sql_bracket('video')}, video_class) * pow({_sql_bracket('reel')}, reel_class)
  * CASE WHEN exclusive > 0 THEN {_sql_bracket('exclusivity')} ELSE 1 END * CASE WHEN "usage" > 0 THEN {_sql_bracket('usage')} ELSE 1 END) AS expected FROM agr),
r AS (SELECT o_orderkey, fee, expected, greatest({_sql_bracket('low')}, expected * 0.7) AS lo, least({_sql_bracket('high')}, expected * 1.5) AS hi FROM e)
SELECT o_orderkey, round(expected, 4) AS expected, round(lo, 4) AS low, round(hi, 4) AS high, fee >= lo AND fee <= hi AS aligned FROM r""")
def rule_fee_alignment(spark, sf):
    allowed = A.aligned_range(F.col("complexity"), *[F.col(c) for c in ("items", "video_class", "reel_class", "exclusive", "usage")])
    rows = agreements(spark, sf).select("o_orderkey", "fee", allowed.alias("r"))
    return rows.select("o_orderkey", *[F.round(f"r.{c}", 4).alias(c) for c in ("expected", "low", "high")],
                       A.rule_fee_alignment(F.col("fee"), F.col("r")).alias("aligned"))


def _sql_platform_ok():
    cases = " ".join(f"WHEN '{k}' THEN [{', '.join(quoted(p) for p in v)}]" for k, v in A.EXPECTED_PLATFORMS.items() if k != "other")
    return f"(len(platforms) = 0 OR list_has_any(platforms, CASE industry {cases} ELSE [{', '.join(quoted(p) for p in A.EXPECTED_PLATFORMS['other'])}] END))"


@query("rule_platform", f"WITH {SQL_AGREEMENTS} SELECT o_orderkey, industry, array_to_string(platforms, '|') AS platforms, {_sql_platform_ok()} AS valid FROM agr")
def rule_platform(spark, sf):
    return agreements(spark, sf).select(
        "o_orderkey", "industry", F.array_join("platforms", "|").alias("platforms"),
        A.rule_platform(F.col("industry"), F.col("platforms")).alias("valid"))


@query("rule_unique_items", f"""
WITH {SQL_AGREEMENTS} SELECT o_orderkey, duplicates = 0 AS valid, duplicates, first_duplicate, coalesce(1 - distinct_items / nullif(items, 0) <= 0.2, true) AS lenient FROM agr""")
def rule_unique_items(spark, sf):
    return agreements(spark, sf, duplicates=True).select(
        "o_orderkey", (F.col("duplicates") == 0).alias("valid"), "duplicates", "first_duplicate",
        A.lenient_unique(F.col("items"), F.col("distinct_items")).alias("lenient"))


def _sql_months(c):
    return (f"CASE WHEN coalesce(TRY_CAST(regexp_extract({c}, '(\\d+)\\s*weeks?', 1) AS INTEGER), 0) > 0 THEN TRY_CAST(regexp_extract({c}, '(\\d+)\\s*weeks?', 1) AS INTEGER) / 4.33::DOUBLE "
            f"ELSE coalesce(TRY_CAST(regexp_extract({c}, '(\\d+)\\s*months?', 1) AS INTEGER), 0)::DOUBLE END")


_SQL_TEMPORAL = [
    ("exclusivity", f"{_sql_months('exclusivity')} > 0 AND ({_sql_months('exclusivity')} < 1 OR {_sql_months('exclusivity')} > 48)"),
    ("usage_term", "CAST(o_orderkey % 70 AS INTEGER) > 60"),
    ("engagement", f"{_sql_months('engagement')} > 0 AND ({_sql_months('engagement')} < 0.25 OR {_sql_months('engagement')} > 24)"),
]


@query("rule_temporal", f"""
WITH {SQL_AGREEMENTS} SELECT o_orderkey, {_sql_issues(_SQL_TEMPORAL)} AS issues, {_sql_months('exclusivity')} <= 24 AS lenient FROM agr""")
def rule_temporal(spark, sf):
    terms = [F.col(c) for c in ("exclusivity", "usage_term", "engagement")]
    return agreements(spark, sf).select(
        "o_orderkey", R.joined(R.issues(A.rule_temporal(*terms))).alias("issues"),
        A.rule_temporal_lenient(terms[0], terms[2], 24).alias("lenient"))


@query("validate_agreement", f"""
WITH {SQL_AGREEMENTS}, v AS (SELECT o_orderkey, {_sql_issues(_SQL_BUSINESS)} = '' AS business_ok, {_sql_issues(_SQL_TEMPORAL)} = '' AS temporal_ok, duplicates = 0 AS deliverable_unique, {_sql_platform_ok()} AS platform_aligned FROM agr)
SELECT *, business_ok AND temporal_ok AND deliverable_unique AND platform_aligned AS overall_valid FROM v""")
def validate_agreement(spark, sf):
    made = A.validate_agreement(
        A.rule_fee_deliverables(F.col("fee"), F.col("items")),
        A.rule_temporal(F.col("exclusivity"), F.col("usage_term"), F.col("engagement")),
        F.col("duplicates"), A.rule_platform(F.col("industry"), F.col("platforms")))
    # the parts are columns first, so that the verdict does not search the terms a second time
    parts = {n: c for n, c in made.items() if n != "overall_valid"}
    judged = agreements(spark, sf, duplicates=True).select("o_orderkey", *[c.alias(n) for n, c in parts.items()])
    return judged.withColumn("overall_valid", reduce(Column.__and__, [F.col(n) for n in parts]))


def _sql_fit(which):
    cases = []
    for name, (preferred, acceptable, poor) in A.PLATFORM_FIT.items():
        words = poor if which == "poor" else preferred + acceptable
        listed = f"[{', '.join(quoted(p) for p in words)}]"
        cases.append(f"industry = '{name}' AND " + (f"list_has_any(platforms, {listed})" if which == "poor" else f"NOT list_has_any(platforms, {listed})"))
    return "(" + " OR ".join(f"({c})" for c in cases) + ")"


_SQL_CAMPAIGN = [
    ("low_fee_many_items", "fee < 5000 AND items > 5"), ("mid_fee_very_many_items", "fee >= 5000 AND fee < 15000 AND items > 10"),
    ("mid_fee_few_items", "fee >= 5000 AND fee < 15000 AND items < 2"), ("high_fee_few_items", "fee >= 35000 AND items < 5"),
    ("no_items", "items <= 0"), ("extreme_fee", "fee > 100000 AND items < 10"), ("no_platform", "len(platforms) = 0"),
    ("poor_platform", f"len(platforms) > 0 AND {_sql_fit('poor')}"), ("no_suitable_platform", f"len(platforms) > 0 AND {_sql_fit('none')}"),
    ("linkedin_consumer", "list_contains(platforms, 'linkedin') AND industry NOT IN ('tech', 'finance', 'business')"),
    ("tiktok_finance", "list_contains(platforms, 'tiktok') AND industry = 'finance'"), ("no_campaign_length", "months <= 0"),
    ("negative_exclusivity", "months > 0 AND ex < 0"), ("exclusivity_short", "months > 0 AND ex >= 0 AND ex < months"),
    ("exclusivity_excessive", "months > 0 AND ex >= 0 AND months <= 1 AND ex > 6"), ("exclusivity_too_long", "months > 0 AND ex >= 0 AND months >= 6 AND ex > months * 3"),
    ("exclusivity_over_maximum", "months > 0 AND ex > 24"), ("exclusivity_short_term", "months > 0 AND months <= 2 AND ex > 12"),
]
SQL_CAMPAIGN = f"{SQL_AGREEMENTS}, camp AS (SELECT *, o_orderkey % 13 AS months, o_orderkey % 31 - 2 AS ex FROM agr)"


def campaigns(spark, sf):
    rows = agreements(spark, sf).withColumn("months", F.col("o_orderkey") % 13).withColumn("ex", F.col("o_orderkey") % 31 - 2)
    rules = A.campaign_rules(*[F.col(c) for c in ("fee", "items", "industry", "platforms", "months", "ex")])
    return rows.withColumn("found", R.issues(rules))


@query("rule_campaign_logic", f"WITH {SQL_CAMPAIGN} SELECT o_orderkey, {_sql_issues(_SQL_CAMPAIGN)} AS issues FROM camp")
def rule_campaign_logic(spark, sf):
    return campaigns(spark, sf).select("o_orderkey", R.joined(F.col("found")).alias("issues"))


@query("auto_adjust", f"""
WITH {SQL_CAMPAIGN}
SELECT o_orderkey, round(CASE WHEN fee >= 35000 AND items < 5 THEN least(fee * 0.7::DOUBLE, items * 4000) WHEN fee < 5000 AND items > 5 THEN greatest(15000, items * 2500) ELSE fee END, 4)::DOUBLE AS fee,
  (CASE WHEN months > 0 AND ex >= 0 AND months <= 1 AND ex > 6 THEN least(12, months * 3) WHEN months > 0 AND ex >= 0 AND ex < months THEN months * 2 ELSE ex END)::DOUBLE AS exclusivity FROM camp""")
def auto_adjust(spark, sf):
    made = A.auto_adjust(F.col("found"), *[F.col(c) for c in ("fee", "items", "months", "ex")])
    return campaigns(spark, sf).select("o_orderkey", F.round(made["fee"], 4).alias("fee"), made["exclusivity"].alias("exclusivity"))


@query("rule_score_simple", f"""
WITH {SQL_AGREEMENTS} SELECT o_orderkey, CASE WHEN items > 0 AND fee / items > 10000 THEN 0.3::DOUBLE WHEN industry = 'fashion' AND list_contains(platforms, 'linkedin') THEN 0.4 WHEN fee < 1000 OR fee > 50000 THEN 0.2 ELSE 0.7 END AS score FROM agr""")
def rule_score_simple(spark, sf):
    clash = (F.col("industry") == "fashion") & F.array_contains("platforms", "linkedin")
    return agreements(spark, sf).select("o_orderkey", A.rule_score_simple(F.col("fee"), F.col("items"), clash).alias("score"))


_ONES = "[" + ", ".join(quoted(w) for w in A.ONES) + "]"
_TENS = "[" + ", ".join(quoted(w) for w in A.TENS) + "]"


def _sql_hundreds(n):
    return (f"concat_ws(' ', CASE WHEN {n} >= 100 THEN {_ONES}[{n} // 100 + 1] || ' hundred' END, CASE WHEN {n} % 100 >= 20 THEN {_TENS}[({n} % 100) // 10 + 1] END, "
            f"nullif({_ONES}[CASE WHEN {n} % 100 < 20 THEN {n} % 100 ELSE {n} % 10 END + 1], ''))")


# the amounts run from zero to beyond a million
@query("number_to_words", f"""
WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey // 50 ELSE floor(o_totalprice * CASE WHEN o_orderkey % 7 = 0 THEN 10 ELSE 1 END)::BIGINT END AS n FROM orders)
SELECT o_orderkey, CASE WHEN n = 0 THEN 'zero' WHEN n < 1000000 THEN concat_ws(' ', CASE WHEN n >= 1000 THEN {_sql_hundreds('(n // 1000)')} || ' thousand' END, CASE WHEN n % 1000 > 0 THEN {_sql_hundreds('(n % 1000)')} END)
  ELSE 'approximately ' || format('{{:,}}', n) END AS spoken FROM a""")
def number_to_words(spark, sf):
    key = F.col("o_orderkey")
    amount = F.when(key % 50 == 0, F.floor(key / 50)).otherwise(F.floor(F.col("o_totalprice") * F.when(key % 7 == 0, 10).otherwise(1))).cast("long")
    return table(spark, sf, "orders").select("o_orderkey", amount.alias("n")).select("o_orderkey", A.number_to_words(F.col("n")).alias("spoken"))


# an agreement text written from the order
@query("extract_fields", f"""
WITH {SQL_AGREEMENTS}
SELECT o_orderkey, 'Customer ' || CAST(o_orderkey % 97 AS VARCHAR) AS client, 'Brand ' || industry AS brand, 'spring ' || industry || ' campaign' AS campaign,
  CASE WHEN o_orderkey % 2 = 0 THEN '$' || format('{{:,}}', fee) ELSE '$' || CAST(fee AS VARCHAR) END AS fee, fee AS fee_numeric, 'first item|second item' AS deliverables,
  CAST(o_orderkey % 130 AS VARCHAR) || ' week' AS engagement_term, CAST(o_orderkey % 70 AS VARCHAR) || ' months' AS usage_term,
  CASE WHEN industry = 'tech' THEN 'tech' WHEN industry = 'fashion' THEN 'fashion' ELSE 'general' END AS industry FROM agr""")
def extract_fields(spark, sf):
    key, industry = F.col("o_orderkey"), F.col("industry")
    fee = F.when(key % 2 == 0, F.concat(F.lit("Total Fee: $"), F.format_number("fee", 0))).otherwise(F.concat("fee", F.lit(" AUD")))
    text = F.concat(
        F.lit("This agreement is between Customer "), (key % 97).cast("string"), F.lit(" and the talent, on behalf of Brand "), industry,
        F.lit(". It is for the spring "), industry, F.lit(" campaign.\n"), fee, F.lit("\nDELIVERABLES:\n- first item\n-  second item\n\nEngagement Period: "),
        F.col("engagement"), F.lit("\nUsage Rights: "), F.col("usage_term"), F.lit("\n"))
    made = A.extract_fields(F.col("text"))
    made["deliverables"] = F.array_join(made["deliverables"], "|")
    return agreements(spark, sf).select("o_orderkey", text.alias("text")).select("o_orderkey", *[c.alias(n) for n, c in made.items()])
