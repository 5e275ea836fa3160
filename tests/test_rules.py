import pytest
from pyspark.sql import functions as F

from loomset.functions import agreements as A
from loomset.functions import rules as R
from loomset.operators import checks as C


@pytest.mark.parametrize("text, weeks, months", [("7 weeks exclusivity", 7, 0), ("3 month", 0, 3), ("none", 0, 0)])
def test_durations(one, text, weeks, months):
    assert one(A.weeks_in, t=text) == weeks
    assert one(A.months_in, t=text) == months


@pytest.mark.parametrize("fee, tier", [(15000, "premium"), (5000, "high"), (2000, "medium"), (1999, "basic")])
def test_fee_tier(one, fee, tier):
    assert one(A.fee_tier, f=fee) == tier


@pytest.mark.parametrize("n, words", [
    (0, "zero"), (15, "fifteen"), (342, "three hundred forty two"), (20000, "twenty thousand"), (100, "one hundred"),
    (999999, "nine hundred ninety nine thousand nine hundred ninety nine"), (1000000, "approximately 1,000,000"), (10010, "ten thousand ten"),
])
def test_number_to_words(one, n, words):
    assert one(A.number_to_words, n=n) == words


def test_short_exclusivity_is_invalid(one):
    got = one(lambda t: R.issues(A.rule_temporal(t, F.lit("6 months"), F.lit("2 weeks"))), t="3 weeks")
    assert got == ["exclusivity"]


def test_duplicates_after_normalising(spark):
    row = spark.createDataFrame([(["2 x Post", "2 x  post ", "Reel"],)], "d array<string>")
    assert row.select(A.duplicate_items(F.col("d"))).first()[0] == ["2 x post"]


def _campaign(spark, fee, items, industry, platforms, months=3.0, exclusivity=6.0):
    row = spark.createDataFrame([(fee, items, industry, platforms, months, exclusivity)],
                                "fee double, items int, industry string, platforms array<string>, m double, e double")
    return row.select(R.issues(A.campaign_rules(*[F.col(c) for c in ("fee", "items", "industry", "platforms", "m", "e")]))).first()[0]


def test_campaign_logic(spark):
    assert _campaign(spark, 4000.0, 6, "fashion", ["instagram"]) == ["low_fee_many_items"]
    assert _campaign(spark, 4000.0, 2, "food", ["linkedin"]) == ["poor_platform", "no_suitable_platform", "linkedin_consumer"]
    assert _campaign(spark, 4000.0, 2, "food", []) == ["no_platform"]
    assert _campaign(spark, 4000.0, 2, "food", ["tiktok"], 1.0, 14.0) == ["exclusivity_excessive", "exclusivity_short_term"]
    assert _campaign(spark, 4000.0, 2, "food", ["tiktok"], 0.0, 14.0) == ["no_campaign_length"]


def test_array_and_table_features_agree(spark):
    items = ["Instagram Post", "YouTube Video", "IG Reel", "TikTok", "Facebook Story with usage"]
    row = spark.createDataFrame([(items,)], "d array<string>")
    from_array = row.select(*[c.alias(n) for n, c in A.item_features(F.col("d")).items()]).first().asDict()
    rows = spark.createDataFrame([(i,) for i in items], "d string")
    flags = rows.select(*[c.alias(n) for n, c in A.item_flags(F.lower("d")).items()])
    from_table = flags.agg(*[c.alias(n) for n, c in A.item_aggregates().items()]).first().asDict()
    assert from_array == from_table


def test_expected_fee_rounds_half_to_even(one):
    fee = one(lambda c: A.expected_fee(c, F.lit("food"), F.lit(1), F.lit(1), F.lit(1), F.lit(1)), c="simple")
    assert fee == round(min(2500, int(500 + 200 + 60 + 400 + 300)) / 50) * 50


def test_auto_adjust(spark):
    row = spark.createDataFrame([(["low_fee_many_items", "exclusivity_short"], 3000.0, 8, 4.0, 2.0)], "f array<string>, fee double, n int, m double, e double")
    made = A.auto_adjust(F.col("f"), *[F.col(c) for c in ("fee", "n", "m", "e")])
    assert row.select(made["fee"], made["exclusivity"]).first()[:] == (20000.0, 8.0)


def test_extract_fields(spark):
    text = ("This agreement is between Acme and Bob on behalf of Brand X. It is for the Spring Campaign now.\nTotal Fee: $12,500\n"
            "DELIVERABLES:\n- one post\n- two reels\n\n- not this\nEngagement Period: 3 months\nUsage Rights: 1 year\n")
    row = spark.createDataFrame([(text,)], "t string")
    got = row.select(*[c.alias(n) for n, c in A.extract_fields(F.col("t")).items()]).first().asDict()
    assert got == {
        "client": "Acme", "brand": "Brand X", "campaign": "Spring Campaign now", "engagement_term": "3 months", "usage_term": "1 year",
        "fee": "$12,500", "fee_numeric": 12500, "deliverables": ["one post", "two reels"], "industry": "general"}


def test_rule_book_rejects_a_second_name():
    book = R.RuleBook()
    book.register("a", None)
    with pytest.raises(ValueError):
        book.register("a", None)


def test_client_consistency(spark):
    rows = spark.createDataFrame(
        [(1, "David Jones Pty Ltd", "for DJ today"), (2, "Acme Ltd", "for acme"), (3, "Acme", "for others"), (4, None, "x")],
        "i int, client string, text string")
    aliases = spark.createDataFrame([("david jones", ["DJ"])], "name string, variations array<string>")
    got = {r.i: r.consistent for r in C.client_consistency(rows, aliases).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True}


def test_tag_sections(one):
    got = one(lambda t: C.tag_sections(t, F.lit("my_doc.md")), t="This agreement is made. Payment terms: none. Exclusivity")
    assert got.startswith("# my doc\n\n## PREAMBLE\n\nThis agreement")
    assert "## PAYMENT TERMS\n\nPayment terms" in got and got.endswith("## EXCLUSIVITY\n\nExclusivity")


def test_required_content(spark):
    row = spark.createDataFrame([("Acme pays 1,500 dollars for the Spring content over a period", "Acme", "spring", 1500, ["reel"])],
                                "t string, c string, k string, f long, d array<string>")
    made = C.required_content(*[F.col(c) for c in "tckfd"])
    assert all(row.select(*[c.alias(n) for n, c in made.items()]).first())
