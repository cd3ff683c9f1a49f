"""Partials at rest: changed months alone are read and replaced."""

import glob
import os

import pytest
from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.plans import questions, summary
from chartwise.session import scratch_path
from chartwise.sources.catalog import read_charts, write_charts
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def charts(spark):
    path = scratch_path(spark, "summary-charts")
    write_charts(clean(ingest(raw_charts(spark, SF), CFG).drop("country_code", "month_str"), CFG.markets), path)
    return read_charts(spark, path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_answers_equal_those_of_the_charts(spark, charts):
    path = scratch_path(spark, "summary")
    summary.update(charts, path)
    kept = summary.read_summary(spark, path)
    assert summary.cross_market_hits(kept).collect() == questions.cross_market_hits(charts).collect()
    assert summary.chart_longevity(kept).collect() == questions.chart_longevity(charts).collect()
    assert summary.yearly_leader(kept).collect() == questions.yearly_leader(charts).collect()


def test_changed_months_alone_are_written(spark, charts):
    path = scratch_path(spark, "summary")
    odd = charts.filter(F.month("date") % 2 == 1)
    summary.update(odd, path)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}
    changed = [m for m in summary.months_in(charts) if int(m[-2:]) % 2 == 0]
    summary.update(charts, path, changed)
    summary.update(charts, path, changed)  # again: the same
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}
    assert before and all(after.get(f) == t for f, t in before.items()) and len(after) > len(before)
    assert rows(summary.read_summary(spark, path)) == rows(summary.summarise(charts))


def test_a_month_that_lost_its_rows(spark, charts):
    path = scratch_path(spark, "summary")
    summary.update(charts, path)
    left = charts.filter(summary.month_of() != "1997-02")
    summary.update(left, path, ["1997-02", "1997-03"])
    assert rows(summary.read_summary(spark, path)) == rows(summary.summarise(left))


def test_months_reach_the_scan(charts):
    plan = summary.of_months(charts, ["1997-02", "1997-03", "1998-12"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan.replace("`", "") or "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date,1997-02-01)" in plan and "LessThan(date,1997-04-01)" in plan
    assert summary.of_months(charts, []).count() == 0


def test_days_of_known_years(spark, charts):
    full = questions.chart_longevity(charts, 50)
    sets = questions.chart_longevity(charts, 50, known_years=(CFG.year_from, CFG.year_to))
    assert sets.collect() == full.collect()
    plan = questions.chart_longevity(charts, 50, known_years=(CFG.year_from, CFG.year_to))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # by song, and by market for the ranking
    assert plan[plan.rindex("WindowGroupLimit"):].count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="out of the known years"):
        questions.chart_longevity(charts, 5, known_years=(1997, 1997)).collect()
    ends = spark.sql("SELECT explode(sequence(date'2016-01-01', date'2019-12-31')) AS date, 'JP' AS region, 't' AS title, 'a' AS artist, 1 AS rank")
    both = ends.unionAll(ends).unionByName(ends.limit(1).withColumn("date", F.lit(None).cast("date")))
    assert questions.chart_longevity(both, known_years=(2016, 2019)).first().days_on_chart == 1461
