"""Chart series: badges, bar threshold, market panels and their order."""

from chartwise.plans.series import series_cross_market, series_longevity, series_yearly
from chartwise.schema import Q1_SCHEMA, Q2_SCHEMA, Q3_SCHEMA, REFERENCE_MARKETS


def test_longevity_panels(spark):
    q2 = spark.createDataFrame([
        ("JP", "a", "x", 10, 3), ("JP", "b", "y", 12, 0), ("VN", "日本語のタイトルです長い", "z", 5, 1),
        ("BR", "c", "w", 99, 1),  # not a listed market: no panel
    ], Q2_SCHEMA)
    rows = series_longevity(q2, REFERENCE_MARKETS).collect()
    assert [(r.country, r.position, r.title) for r in rows] == [
        ("Vietnam", 1, "日本語のタイトルです長い"), ("Japan", 1, "b"), ("Japan", 2, "a")]
    by_title = {r.title: r for r in rows}
    assert by_title["b"].badge is None and by_title["a"].badge == "#3"
    assert by_title["日本語のタイトルです長い"].label == "?" * 12 + "\nz"


def test_yearly_bars(spark):
    q3 = spark.createDataFrame([(2017, 300_000_000, "t", "a", 1), (2018, 4_200_000_000, "Song", "Art", 9)],
                               Q3_SCHEMA)
    rows = series_yearly(q3).collect()
    assert [r.bar_text for r in rows] == ["0.30B", "4.20B"]
    assert rows[0].song_text is None  # 0.3 is not above the 0.3 threshold
    assert rows[1].song_text == "Song\nArt"


def test_cross_market_bars(spark):
    q1 = spark.createDataFrame([("t" * 40, "a" * 30, 5, 9), ("s", "b", 3, 9), ("u", "c", 8, 1)], Q1_SCHEMA)
    rows = {r.title: r for r in series_cross_market(q1).collect()}
    assert rows["t" * 40].label == "a" * 20 + "  -  " + "t" * 28
    assert rows["t" * 40].color == "#1864AB" and rows["s"].color == "#A5D8FF" and rows["u"].color == "#A5D8FF"
    assert rows["u"].position == 1 and rows["u"].legend == "Charted in 8 markets"
