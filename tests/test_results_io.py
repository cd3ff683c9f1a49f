"""Result files: exact TSV round trip and the noise-tolerant line reader."""

import os

from pyspark.sql import types as T

from chartwise.sources.results import read_noisy_lines, read_result_tsv, write_result_tsv

SCHEMA = T.StructType([T.StructField("title", T.StringType()), T.StructField("n", T.LongType())])


def test_tsv_round_trip_is_exact(spark, tmp_dir):
    titles = ["tab\there", 'quote " in', "new\nline", "back\\slash", "  padded  ", "null", "NA", "", None]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(titles)], SCHEMA)
    path = os.path.join(tmp_dir, "rt")
    write_result_tsv(df, path)
    back = {r.n: r.title for r in read_result_tsv(spark, path, SCHEMA).collect()}
    for i, t in enumerate(titles):
        expected = None if t == "" else t  # empty text is written like NULL
        assert back[i] == expected, (i, t, back[i])


def test_noise_filter(spark, tmp_dir):
    path = os.path.join(tmp_dir, "noisy.txt")
    with open(path, "w") as f:
        f.write("OK\n"
                "title\tn\n"
                "Song A\t3\n"
                "no tab in this line\n"
                "Time taken: 1.2 seconds\tFetched: 2 row(s)\n"
                "WARN \tsomething\n"
                "title\tn\n"
                "Song B\tnot-a-number\n"
                "Song C\t7\n")
    rows = read_noisy_lines(spark, path, ["title", "n"], numeric=["n"]).collect()
    assert sorted((r.title, r.n) for r in rows) == [("Song A", 3.0), ("Song C", 7.0)]


def test_missing_result_is_empty_when_allowed(spark, tmp_dir):
    import pytest
    missing = os.path.join(tmp_dir, "nothing-here")
    assert read_result_tsv(spark, missing, SCHEMA, missing_ok=True).count() == 0
    with pytest.raises(Exception):
        read_result_tsv(spark, missing, SCHEMA).collect()
