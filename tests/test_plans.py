"""Plan shapes the design relies on (guards against regressions)."""

import contextlib
import io

import pytest

from chartwise.operators.clean import clean
from chartwise.operators.ingest import ingest
from chartwise.plans.questions import chart_longevity, cross_market_hits, yearly_leader
from chartwise.session import scratch_path
from chartwise.sources.catalog import register_table, write_charts
from chartwise.sources.csv import read_raw_csv, write_raw_csv
from chartwise.sources.fixtures import FIXTURE_CONFIG as CFG
from chartwise.sources.fixtures import raw_charts

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "plans")
    write_charts(clean(ingest(raw_charts(spark, SF), CFG).drop("country_code", "month_str"), CFG.markets), path)
    return register_table(spark, path, "t_plans", "charts")


@pytest.fixture(scope="module")
def raw_csv(spark):
    path = scratch_path(spark, "plans-raw")
    write_raw_csv(raw_charts(spark, SF), path)
    return path


def test_q1_is_top_k_over_partial_aggregates(table):
    p = plan(cross_market_hits(table))
    assert "TakeOrderedAndProject" in p
    assert p.count("partial_count") >= 2  # both levels combine map-side
    assert "ReadSchema: struct<title:string,artist:string>" in p  # region is a partition column


def test_dates_and_numbers_are_parsed_once(spark, raw_csv):
    fused = clean(ingest(read_raw_csv(spark, raw_csv), CFG).drop("country_code", "month_str"), CFG.markets)
    p = fused._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("RLIKE") == 2  # once for ingest's range, once for the typed column
    assert p.count("decimal(38,18)") == 2  # rank and streams


def test_q1_on_known_markets_is_one_exchange(table):
    p = plan(cross_market_hits(table, known_markets=[m.code for m in CFG.markets]), "simple")
    assert p.count("Exchange hashpartitioning") == 1 and "TakeOrderedAndProject" in p


def test_q2_uses_window_group_limit(table):
    p = plan(chart_longevity(table))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_q3_prunes_to_one_market(table):
    p = plan(yearly_leader(table, "JP"))
    assert "PartitionFilters: [isnotnull(region" in p and "(region#" in p and "= JP)" in p
    assert "ReadSchema: struct<title:string,artist:string,streams:bigint>" in p


def test_ingest_is_map_side_with_pushed_filter(spark, raw_csv):
    p = plan(ingest(read_raw_csv(spark, raw_csv), CFG))
    assert "EqualTo(chart,top200)" in p
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def test_write_layout_is_one_rebalance_exchange(table):
    layout = table.hint("rebalance", "region", "year").sortWithinPartitions("region", "year", "date", "rank")
    p = plan(layout, "simple")
    assert p.count("REBALANCE_PARTITIONS_BY_COL") >= 1
