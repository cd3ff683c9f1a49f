"""Property checks of column helpers against plain-Python semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwise.functions.casts import to_long_lenient
from chartwise.functions.text import label, normalize_name

texts = st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40), min_size=1,
                 max_size=30)


@settings(max_examples=15, deadline=None)
@given(texts, st.integers(min_value=1, max_value=30))
def test_label_is_python_slice_then_ascii_replace(spark, values, n):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.l for r in df.select("i", label("v", n).alias("l")).collect()}
    for i, v in enumerate(values):
        assert got[i] == v[:n].encode("ascii", errors="replace").decode()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.integers(min_value=-(2 ** 62), max_value=2 ** 62),
                          st.floats(min_value=-1e12, max_value=1e12, allow_nan=False)), min_size=1, max_size=30))
def test_lenient_long_truncates_and_is_exact_for_integers(spark, values):
    rows = [(i, str(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("i", T.IntegerType()),
                                                   T.StructField("s", T.StringType())]))
    got = {r.i: r.x for r in df.select("i", to_long_lenient("s").alias("x")).collect()}
    for i, v in enumerate(values):
        assert got[i] == int(v), (v, got[i])


@given(st.text(max_size=20))
def test_normalize_name(name):
    out = normalize_name(name)
    assert out == name.strip().lower().replace(" ", "_")


def test_label_counts_code_points(spark):
    df = spark.range(1).select(F.lit("\U0001F3B5 é日本").alias("v"))
    assert df.select(label("v", 3).alias("l")).first().l == "? ?"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["japan", "south korea", "hong kong", "brazil", "Viet nam"]),
                          st.text(alphabet=" \t\n", max_size=3), st.text(alphabet=" \t\n", max_size=3),
                          st.booleans()), min_size=1, max_size=20))
def test_market_code_matches_python_rule(spark, items):
    from chartwise.functions.markets import market_code
    from chartwise.schema import REFERENCE_MARKETS
    codes = {m.key: m.code for m in REFERENCE_MARKETS}
    raw = [pre + (name.upper() if up else name) + post for name, pre, post, up in items]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, region string")
    got = {r.i: r.c for r in df.select("i", market_code("region", REFERENCE_MARKETS).alias("c")).collect()}
    for i, r in enumerate(raw):
        assert got[i] == codes.get(r.strip(" \t\n\r\x0b\x0c").lower(), r)
