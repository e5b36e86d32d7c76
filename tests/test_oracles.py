"""Queries against their SQL oracles on the smallest tables."""

import os

import pytest

from checks.compare import compare, connect
from checks.oracles import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"
WHOLE_RUNS = {"popularity_index", "full_export", "report_overall", "report_chart", "score_missing_source"}
LIGHT = {
    "scan_chart", "scan_measures", "scan_union_files", "extract_page_items", "extract_table_totals", "pending_weeks",
    "flatten_snapshot", "json_positive", "append_dedup", "coerce_numeric", "chart_aggregate", "playlist_membership",
    "unambiguous_titles", "validated_join", "last_wins_lookup", "best_per_key", "authoritative_flag", "artist_tokens",
    "strip_accents", "title_key", "artist_key", "primary_artist", "split_featured", "split_collaborators", "parse_lines",
}


def test_every_query_has_an_oracle():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(WHOLE_RUNS | LIGHT))
def test_oracle(spark, name):
    ok, info = compare(spark, connect(SF), SF, name)
    assert ok, info
