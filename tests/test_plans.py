"""Shapes of plans that must hold at scale."""

import io
from contextlib import redirect_stdout

import pytest

from loomset.plans import load

SF = "/root/testdata/sf0.001"


def explained(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def queries():
    return load().QUERIES


def test_registry_needs_no_session_and_names_agree(queries):
    assert len(queries) > 200 and set(load().SQL) <= set(queries)


@pytest.mark.parametrize("name", ["near_dup_text_pairs", "positive_pairs_window", "negative_pairs", "jaccard_negatives", "manifest_diff", "compat_check"])
def test_no_cartesian_product(spark, queries, name):
    assert "CartesianProduct" not in explained(queries[name](spark, SF))


@pytest.mark.parametrize("name", ["redact_pii", "chunk_greedy", "validate_agreement", "text_metadata"])
def test_no_python_in_column_functions(spark, queries, name):
    plan = explained(queries[name](spark, SF))
    assert "Python" not in plan and "Pandas" not in plan


def test_cleaning_leaves_the_jvm_once(spark, queries):
    # NFKC has no JVM function; texts within ASCII are null there
    plan = explained(queries["clean_text"](spark, SF))
    assert plan.split("== ")[1].count("+- ArrowEvalPython") + plan.count("* ArrowEvalPython") <= 1 and "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, queries):
    plan = explained(queries["lookup_by_id"](spark, SF))
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,42)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan
    assert "text" not in explained(queries["class_distribution"](spark, SF)).split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["key_phrases", "keywords"])
def test_counts_within_a_row_need_no_exchange(spark, queries, name):
    assert "Exchange" not in explained(queries[name](spark, SF))


@pytest.mark.parametrize("name", ["validate_agreement", "rule_unique_items"])
def test_lines_are_scanned_once(spark, queries, name):
    assert explained(queries[name](spark, SF)).count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["validate_agreement", "rule_unique_items", "rule_platform", "expected_fee"])
def test_lines_are_aggregated_by_more_tasks_the_more_lines(spark, queries, name, monkeypatch):
    from loomset.plans import ruling

    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    monkeypatch.setattr(ruling, "_LINES", lines // 60, raising=False)
    dealt = f"{-(-lines // (lines // 60))}), REPARTITION_BY_NUM"
    plan = explained(queries[name](spark, SF))
    assert plan.count(dealt) == 1
    # no groups are kept in the task that scans
    steps = queries[name](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(steps) if "FileScan" in line and "l_orderkey" in line)
    above = next(i for i in range(scan, 0, -1) if "Exchange" in steps[i])
    assert not any("Aggregate" in line for line in steps[above:scan])


def test_top_n_is_limited_before_the_shuffle(spark, queries):
    assert "WindowGroupLimit" in explained(queries["top_n_per_group"](spark, SF))


def test_template_overlap_reads_the_texts_once(spark, queries):
    plan = explained(queries["template_overlap"](spark, SF))
    assert sum("Location" in line and "documents.parquet" in line for line in plan.splitlines()) == 1
