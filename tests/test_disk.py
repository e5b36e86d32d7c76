"""What a run leaves on disk on its way, and what it reads once."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks.adapters import SETTINGS
from evergreen.operators.cluster import cluster_changes
from evergreen.plans import links, run, scores, sinks
from evergreen.session import FREE_SHUFFLES, materialize, run_folder

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in found.mkString("\n").split("\n") if "/shuffle_" in f}


def left_over(spark, write) -> set[str]:
    """Shuffle files that ``write`` leaves; Spark deletes them without waiting."""
    before = shuffle_files(spark)
    write()
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def left_in(folder: str) -> list[str]:
    return sorted(re.sub(r"^evergreen-|-[0-9a-f]{32}$", "", n) for n in os.listdir(folder.removeprefix("file:")))


def test_the_setting_for_shuffles_outlives_a_failing_write(spark):
    before = spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(Exception, match="lost"):
        materialize(spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("x")), "broken")
    assert spark.conf.get(FREE_SHUFFLES) == before


@needs_tables
def test_each_source_is_written_by_itself(spark):
    with run_folder(spark) as folder:
        rows = scores.source_rows(q.sources(spark, SF), SETTINGS)
        assert left_in(folder) == ["chart", *["rows"] * 5]
        per_source = {r.source: r.source_ord for r in rows.select("source", "source_ord").distinct().collect()}
    assert per_source == {"chart": 0, "streams": 1, "videos": 2, "store": 3, "subscription": 4}


def test_clusters_keep_only_their_last_links(spark):
    rows = spark.createDataFrame(
        [("t", a.lower(), a, i, 10 - i) for i, a in enumerate(["A & B", "B & C", "C & D", "D & E", "E", "X"])],
        "key_title string, key_artist string, artist string, source_ord int, value long",
    )
    with run_folder(spark) as folder:
        changes = cluster_changes(rows, {})
        assert left_in(folder) == ["links"]
        assert {r.canonical for r in changes.collect()} == {"a & b"} and changes.count() == 4


@needs_tables
def test_exports_are_read_and_keyed_once(spark):
    scored = spark.createDataFrame([(1, "red ring", "x")], "rank long, title string, artist string")
    with run_folder(spark) as folder:
        for found in (
            links.resolve_links(scored, q.exports(spark, SF), SETTINGS),
            links.link_songs(scored.drop("rank"), q.exports(spark, SF)),
        ):
            assert "l_orderkey" not in plan(found) and found.count() == 1
        assert left_in(folder) == ["links-by-pair"] * 2


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = spark.conf.get(FREE_SHUFFLES)
    assert left_over(spark, lambda: materialize(df, "freed")) == set()
    assert left_over(spark, lambda: run.write_table(df, str(tmp_path / "csv"), "csv", "k")) == set()
    # Only the check of what was published, one row, is a query and no write.
    checked = left_over(spark, lambda: sinks.publish(df, str(tmp_path / "sink"), order="k"))
    assert len({re.search(r"shuffle_\d+", f)[0] for f in checked}) <= 1
    assert spark.conf.get(FREE_SHUFFLES) == before
    assert left_over(spark, lambda: df.write.format("noop").mode("overwrite").save())  # the test sees such files
