"""Physical plans: no Python, no nested loops, pruned scans, pre-aggregation before shuffles."""

import os
import re

import pytest
from pyspark.sql import functions as F

from checks.adapters import SETTINGS, exports, view
from checks.queries import queries
from evergreen.functions.text import with_keys
from evergreen.operators import lookup, ranking
from evergreen.plans import links as links_plan
from evergreen.plans import reports
from evergreen.sources.chart import chart_aggregate, chart_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check(text: str) -> None:
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"):
        assert bad not in text


@pytest.mark.parametrize(
    "name",
    ["scan_chart", "chart_aggregate", "merge_measures", "link_lookup", "validated_join", "unambiguous_titles",
     "best_per_key", "authoritative_flag", "strip_accents", "append_dedup", "extract_page_items", "scale_to_100"],
)
def test_plans_stay_native(spark, name):
    check(plan(queries()[name](spark, SF)))


def test_chart_scan_is_pruned_and_folded_before_the_shuffle(spark):
    text = plan(chart_aggregate(chart_rows(view(spark, SF, "chart_src")), SETTINGS))
    scan = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*", text.split("l_orderkey", 1)[0] + "l_orderkey" + text.split("l_orderkey", 1)[1])
    assert scan and "l_tax" not in text and "l_discount" not in text and "p_retailprice" not in text
    assert "Window" not in text
    assert "HashAggregate" in text.split("Exchange hashpartitioning(title")[1]


def test_the_first_row_is_found_by_hashes_before_the_first_shuffle(spark):
    text = plan(queries()["first_per_key"](spark, SF))
    hashed = re.findall(r"Exchange hashpartitioning\(_keys[^\n]*\n[^\n]*", text)
    assert any("HashAggregate(keys=[_keys" in h for h in hashed)
    # Whole rows are folded one by one only behind the join that brings them back.
    assert "Join" in text.split("SortAggregate")[-1]


def test_hot_keys_of_lookups_are_found_without_a_shuffle(spark):
    left = spark.range(1000).select(F.col("id").alias("ord"), (F.col("id") % 7).alias("k"))
    right = spark.range(7).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    text = plan(lookup.validated_left_join(left, right, ["k"], ["ord"]))
    assert "approx_top_k" in text and "Exchange hashpartitioning(_hash" not in text


def test_filters_above_keys_reach_the_scan(spark):
    part = spark.read.parquet(f"{SF}/part.parquet").withColumnsRenamed({"p_name": "title", "p_brand": "artist"})
    text = plan(with_keys(part, SETTINGS.aliases).filter("p_size = 3").select("key_title", "key_artist"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(p_size,3\)", text)


def test_the_overall_report_takes_its_songs_by_rank(spark):
    scores = spark.createDataFrame([(1, "t", "a", 2000, 9.0)], "rank long, title string, artist string, year int, final_score double")
    text = plan(reports.overall_report(scores, None, SETTINGS))
    assert "TakeOrdered" not in text and "GlobalLimit" not in text


def test_top_n_never_sorts_everything(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    assert "TakeOrderedAndProject" in plan(ranking.top_n(df, [F.col("v").desc(), F.col("id")], 5))


def test_links_need_no_global_sort(spark):
    scores = spark.createDataFrame([(1, "red ring", "x")], "rank long, title string, artist string")
    text = plan(links_plan.resolve_links(scores, exports(spark, SF), SETTINGS))
    check(text)
    assert "TakeOrdered" not in text and "GlobalLimit" not in text
