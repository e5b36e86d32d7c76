"""Reading that spares failing casts and spreads small files with much work."""

import os

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from evergreen.functions import parse, text
from evergreen.sources import files

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_pages_are_read_by_several_tasks(spark):
    """A small file of lines is one part; its pages are far more work."""
    for pages in (q._table_pages(spark, SF), q._wide_pages(spark, SF)):
        assert pages._jdf.rdd().getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_casts_and_parses_that_must_fail_are_not_tried(spark):
    df = spark.createDataFrame([("x",)], "t string").repartition(1)
    number, day = files.to_number(F.col("t")), files.calendar_date(df, "t")
    shown = plan(df.select(number.alias("n"), day.alias("d"), parse.parse_count(F.col("t")).alias("c")))
    assert "RLIKE" in shown and "Contains(" in shown
    year = plan(df.select(parse.release_year(F.col("t")).alias("y")))
    assert "Contains(" in year


def test_numbers_and_dates_are_read_as_by_plain_casts(spark):
    numbers = ["5", " 5 ", "\t7\n", "+5", "-5", "5.", "5.0", ".5", "1e3", "1E400", "inf", "-Infinity", "NaN", "n/a", "", "  ",
               "0x1p3", "5d", "9007199254740993", "9007199254740993.0", "9223372036854775808", "99999999999", "3,000",
               "٣", "1.2.3", "true", "-", None]
    x = F.col("x")
    texts = spark.createDataFrame([(t,) for t in numbers], "x string")
    for kind in ("int", "bigint"):
        plain = F.coalesce(x.try_cast(kind), x.try_cast("double").try_cast(kind))
        for other in ("string", "double", "decimal(38,2)", "boolean"):
            df = texts.select(x.try_cast(other).alias("x")).select("x", files.to_number(x, kind).alias("a"), plain.alias("b"))
            assert df.filter("NOT a <=> b").collect() == []
    days = ["1999-02-03", "3/4/1999", "1999/3/4", " 3/4/1999 ", "March 4, 1999", "Mar 4, 1999", "4 March 1999", "4 Mar 1999",
            "soon", "", "1999", "13/45/1999", "mar 4,1999", "1999-2-3T10:00:00", "-2001-05-01", "x2001y", "a b", "x/y", None]
    df = spark.createDataFrame([(d,) for d in days], "x string")
    plain = F.coalesce(F.try_to_date(F.trim(x)), *(F.try_to_date(F.trim(x), f) for f in files.DATE_FORMATS))
    year = F.coalesce(F.year(F.try_to_date(x, "yyyy-MM-dd")), F.regexp_extract(x, r"(\d{4})", 1).try_cast("int"))
    both = df.select(
        "x", files.calendar_date(df, "x").alias("a"), plain.alias("b"), parse.release_year(x).alias("c"), year.alias("d")
    )
    assert both.filter("NOT a <=> b OR NOT c <=> d").collect() == []
    assert both.filter("a IS NOT NULL").count() == 11


def test_plain_credits_are_told_without_the_long_pattern(spark):
    names = ["ABBA", "Lil Nas X", "a x b", "A X B", "x b", "a x", "a  x  b", "Simon with", "Iron with Wine", "a vs. b", "a VS b",
             "A ft. B", "A Feat B", "A featuring B", "AC/DC", "huntr/x", "a, b", "a & b", "a:b", "'Weird' Al", '"q"', "Beyoncé x Z",
             "a\tx\tb", "a\nb", "a\n", "a\r", "", " ", "  a  ", "a;b", "Ke$ha!", "P!nk (live)", "50% [x]", "a⁄b", "a|b~c", "aſ x b",
             "a x b", "the x", "feat. b", "a ft.b", "a_x_b", "1 x 2", "#1 with ", " with a", "@x", "a-b", "a.b", "\x1fa", "a\x7f", None]
    df = spark.createDataFrame([(n,) for n in names], "a string")
    a = F.col("a")
    both = df.select(
        "a",
        text.is_single_name(a).alias("s"),
        F.rlike(a, F.lit(text.SINGLE_NAME)).alias("t"),
        text.collaborators_joined(a).alias("c"),
        F.array_join(text.collaborators(a), ";").alias("d"),
    )
    assert both.filter("NOT s <=> t OR NOT c <=> d").collect() == [] and both.filter("s").count() > 15
    # Most credits are plain; the long pattern looks ahead from every place and costs 16 us a credit.
    assert plan(df.select(text.is_single_name(a))).count("RLIKE") >= 3
