"""Independent DuckDB SQL for every registered query (the correctness gate).
Constants are written out here, so a wrong one in the engine shows.

The driver registers the test tables as views; each statement rebuilds the
raw chart rows with the same rules as ``sources.fixtures`` and then states
the operator in plain SQL. Counts and sums are cast to BIGINT, years and
ranks to INT, so both engines report the same types.
"""

from __future__ import annotations

# every white-space code point
WS = " || ".join(f"chr({k})" for k in [32, 9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
KEY = f"lower(trim(region, {WS}))"
YEAR_LO, YEAR_HI = "DATE '1996-01-01'", "DATE '2001-01-01'"


def day(col: str) -> str:
    """A date, alone or with a time of day after a blank or T."""
    return (f"CASE WHEN regexp_full_match(trim({col}, {WS}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9:]+)?') "
            f"THEN TRY_CAST(substr(trim({col}, {WS}), 1, 10) AS DATE) END")


def whole(col: str, kind: str) -> str:
    """A whole number, decimals cut off."""
    return f"TRY_CAST(trunc(TRY_CAST({col} AS DECIMAL(38, 9))) AS {kind})"


PDATE = day("date")

MARKETS = """markets(market_key, code, display, ordinal) AS (VALUES ('nation_7', 'VN', 'Vietnam', 1),
  ('nation_12', 'KR', 'Korea', 2), ('nation_2', 'JP', 'Japan', 3), ('nation_17', 'TW', 'Taiwan', 4), ('nation_22', 'HK', 'Hong Kong', 5))"""

RAW = """raw_charts AS (
  SELECT
    CASE WHEN l.l_orderkey % 97 = 0 THEN 'not-a-date'
         WHEN l.l_orderkey % 89 = 0 THEN CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00'
         WHEN l.l_orderkey % 83 = 0 THEN CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) || 'T12:30:00'
         WHEN l.l_orderkey % 79 = 0 THEN CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) || ' '
         ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS date,
    CASE WHEN o.o_orderkey % 3 = 0 THEN ' ' || upper(n.n_name) || ' '
         WHEN o.o_orderkey % 5 = 0 THEN chr(160) || n.n_name || chr(12288) ELSE n.n_name END AS region,
    CASE WHEN o.o_orderstatus = 'P' THEN 'viral50' ELSE 'top200' END AS chart,
    CASE WHEN l.l_returnflag = 'A' THEN 'MOVE_UP' WHEN l.l_returnflag = 'R' THEN 'MOVE_DOWN'
         ELSE 'NEW_ENTRY' END AS trend,
    CAST(1 + (l.l_orderkey * 7 + l.l_linenumber * 31) % 210 AS VARCHAR) AS rank,
    CASE WHEN l.l_partkey % 50 = 0 THEN NULL ELSE p.p_name END AS title,
    p.p_brand AS artist,
    CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_linenumber = 6 THEN '0.0'
         ELSE CAST(l.l_quantity AS VARCHAR) END AS streams,
    'https://example.com/track/' || CAST(p.p_partkey AS VARCHAR) AS url
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RAW_COLS = "date, region, chart, trend, rank, title, artist, streams, url"

INGESTED = f"""ingested AS (
  SELECT r.date, r.region, r.chart, r.trend, r.rank, r.title, r.artist, r.streams, r.url,
         m.code AS country_code, strftime({day("r.date")}, '%Y-%m') AS month_str
  FROM raw_charts r JOIN markets m ON lower(trim(r.region, {WS})) = m.market_key
  WHERE r.chart = 'top200' AND {day("r.date")} >= {YEAR_LO} AND {day("r.date")} < {YEAR_HI}
)"""


def typed(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT {PDATE} AS date,
         COALESCE(mk.code, s.region) AS region, s.chart, s.trend,
         {whole("s.rank", "INTEGER")} AS rank,
         s.title, s.artist,
         {whole("s.streams", "BIGINT")} AS streams, s.url,
         CAST(year({PDATE}) AS INTEGER) AS year
  FROM {src} s LEFT JOIN markets mk ON lower(trim(s.region, {WS})) = mk.market_key
)"""


def complete(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  WHERE title IS NOT NULL AND artist IS NOT NULL AND streams IS NOT NULL AND region IS NOT NULL
    AND date IS NOT NULL AND rank IS NOT NULL
)"""


def valid(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {src} WHERE streams > 0 AND rank BETWEEN 1 AND 200
)"""


CHARTS = ",\n".join([INGESTED, typed("ingested_typed", "ingested"), complete("ingested_complete", "ingested_typed"),
                     valid("charts", "ingested_complete")])

Q1 = """q1 AS (
  SELECT title, artist, len(list(DISTINCT region))::BIGINT AS num_countries, count(*)::BIGINT AS total_appearances
  FROM charts GROUP BY ALL HAVING num_countries >= 3
  ORDER BY num_countries DESC, total_appearances DESC, title, artist LIMIT 30
)"""

Q2 = """q2 AS (
  FROM charts
  SELECT region, title, artist, count(DISTINCT date)::BIGINT AS days_on_chart, min(rank)::INTEGER AS best_rank
  GROUP BY region, title, artist
  QUALIFY row_number() OVER (PARTITION BY region ORDER BY days_on_chart DESC, title, artist) <= 5
)"""

SONG_YEAR = """song_year AS (
  FROM charts SELECT year, title, artist, sum(streams)::BIGINT AS peak_streams WHERE region = 'JP' GROUP BY ALL
)"""
YEAR_TOTALS = """year_totals AS (
  FROM charts SELECT year, sum(streams)::BIGINT AS total_streams WHERE region = 'JP' GROUP BY ALL
)"""
Q3 = """q3 AS (
  SELECT year, sum(peak_streams)::BIGINT AS total_streams, best.title AS title, best.artist AS artist, best.peak_streams AS peak_streams
  FROM (SELECT year, peak_streams, first(song_year) OVER (PARTITION BY year ORDER BY peak_streams DESC, title, artist) AS best FROM song_year)
  GROUP BY year, best
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (MARKETS, RAW)
CH = (*BASE, CHARTS)


def label_sql(col: str, n: int, ascii_only: bool = True) -> str:
    s = f"substr(COALESCE(CAST({col} AS VARCHAR), ''), 1, {n})"
    return f"regexp_replace({s}, '[^\\x00-\\x7F]', '?', 'g')" if ascii_only else s


# fixed values: how lines of console noise begin
NOISE = ("Note ", "WARN ", "INFO ", "SLF4J", "OK", "Time taken", "Logging", "deprecated", "hive>", "WARNING")


def _noise_lines() -> str:
    """Every line that the fixture writes, then the reader's rules."""
    id_ = "CAST(doc_id AS VARCHAR)"
    kinds = [f"SELECT {id_} || chr(9) || line || chr(9) || CAST(length(line) AS VARCHAR) AS value FROM doc_line"]
    kinds += [f"SELECT '{p}seen' || chr(9) || 'x' || chr(9) || {id_} FROM documents" for p in NOISE]
    kinds += [f"SELECT 'doc_id' || chr(9) || 'line' || chr(9) || {id_} FROM documents", f"SELECT {id_} FROM documents",
              f"SELECT {id_} || chr(9) || 'short' FROM documents", f"SELECT {id_} || chr(9) || 'a' || chr(9) || '1' || chr(9) || 'b' FROM documents",
              f"SELECT 'none' || chr(9) || 'of ' || {id_} || chr(9) || '12d' FROM documents"]
    noise = " AND ".join(f"NOT starts_with(value, '{p}')" for p in NOISE)
    return f"""WITH doc_line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
written AS ({" UNION ALL ".join(kinds)}),
field AS (SELECT string_split(value, chr(9)) AS f FROM written WHERE contains(value, chr(9)) AND {noise}),
num AS (SELECT TRY_CAST(f[1] AS DOUBLE) AS doc_id, f[2] AS line, TRY_CAST(f[3] AS DOUBLE) AS width FROM field WHERE len(f) <= 3 AND f[1] <> 'doc_id')
SELECT doc_id, line, width FROM num WHERE doc_id IS NOT NULL OR width IS NOT NULL"""


def reasons(source: str) -> str:
    """Why each row of ``source`` (raw rows with a flag ``bad``) goes, if it does."""
    return f""", source AS ({source}), parsed AS (
  SELECT s.*, {day("s.date")} AS d, {whole("s.rank", "INTEGER")} AS rk, {whole("s.streams", "BIGINT")} AS st, m.code AS country_code
  FROM source s LEFT JOIN markets m ON lower(trim(s.region, {WS})) = m.market_key),
judged AS (SELECT *, strftime(d, '%Y-%m') AS month_str, CASE WHEN bad THEN 'bad record' WHEN chart IS DISTINCT FROM 'top200' THEN 'chart kind' WHEN d IS NULL THEN 'date'
    WHEN d < {YEAR_LO} OR d >= {YEAR_HI} THEN 'years' WHEN country_code IS NULL THEN 'market'
    WHEN title IS NULL OR artist IS NULL OR st IS NULL OR rk IS NULL THEN 'incomplete'
    WHEN st <= 0 OR rk NOT BETWEEN 1 AND 200 THEN 'out of range' ELSE 'kept' END AS reason FROM parsed)
"""


def oracle_sql() -> dict[str, str]:
    # fixed values: bar colour by number of markets
    colors = "WHEN 3 THEN '#A5D8FF' WHEN 4 THEN '#339AF0' WHEN 5 THEN '#1864AB' WHEN 6 THEN '#003A8C' WHEN 7 THEN '#001D4A'"
    gate_q = " UNION ALL ".join(
        f"SELECT '{g}' AS gate, CAST(COUNT(*) AS BIGINT) AS rows FROM {src}"
        for g, src in (("ingest", "ingested"), ("table", "charts"), ("result_q1", "q1"), ("result_q2", "q2"),
                       ("result_q3", "q3")))
    grown = "grown AS (SELECT * FROM charts WHERE day(date) % 2 = 1 OR month(date) % 2 = 0)"
    all_typed = (*BASE, typed("all_typed", "raw_charts"), complete("all_complete", "all_typed"),
                 valid("all_valid", "all_complete"))
    return {
        "scan_raw_csv": with_(*BASE) + f"SELECT {RAW_COLS} FROM raw_charts",
        "split_counts": with_(*CH) + "SELECT country_code, month_str, CAST(COUNT(*) AS BIGINT) AS rows "
                                     "FROM ingested GROUP BY country_code, month_str",
        "parquet_roundtrip": with_(*CH) + "SELECT * FROM charts",
        "table_roundtrip": with_(*CH) + "SELECT * FROM charts",
        "scan_raw_csv_messy": """SELECT '1998-01-01' AS date, 'nation_2' AS region, 'top200' AS chart, NULL::VARCHAR AS trend, '1' AS rank,
  text AS title, source || ', "' || lang || '"' AS artist, CAST(n_chars AS VARCHAR) AS streams, 'x,' || chr(10) || CAST(doc_id AS VARCHAR) AS url
FROM documents""",
        "bad_csv_records": """SELECT count(*)::BIGINT AS raw_rows, (count(*) FILTER (WHERE doc_id % 7 IN (1, 2)))::BIGINT AS bad_records,
  (count(*) FILTER (WHERE doc_id % 7 NOT IN (1, 2)))::BIGINT AS good_rows FROM documents""",
        "misframed_csv": """SELECT CASE WHEN doc_id % 7 NOT IN (1, 3) THEN text END AS title,
  CASE WHEN doc_id % 7 = 4 THEN 'a "b", c' WHEN doc_id % 7 = 5 THEN '12" mix' WHEN doc_id % 7 NOT IN (1, 3) THEN 'a' END AS artist,
  CASE WHEN doc_id % 7 = 4 THEN 'http' || chr(10) || doc_id WHEN doc_id % 7 NOT IN (1, 3) THEN doc_id::VARCHAR END AS url,
  CASE WHEN doc_id % 7 = 1 THEN '1998-01-01,nation_2' WHEN doc_id % 7 = 3 THEN '1998-01-01,nation_2,top200,,1,t,a,5,"http' || doc_id END AS bad
FROM documents""",
        "reject_reasons": with_(*BASE) + reasons(
            "SELECT * REPLACE (CASE WHEN rank LIKE '%4' THEN '' ELSE region END AS region), artist LIKE '%1' AND rank LIKE '%3' AS bad FROM raw_charts")
            + "SELECT reason, count(*)::BIGINT AS rows FROM judged GROUP BY reason",
        "defect_rows": with_(*BASE) + reasons("SELECT *, false AS bad FROM raw_charts")
            + f"SELECT reason, {RAW_COLS}, country_code, month_str FROM judged WHERE reason IN ('bad record', 'date', 'incomplete', 'out of range')",
        "empty_region": with_(*all_typed) + "SELECT * FROM all_valid WHERE rank % 10 <> 4",
        "q1_unlisted_markets": with_(*all_typed, Q1.replace("FROM charts", "FROM all_valid")) + "SELECT * FROM q1",
        "parquet_codec": with_(*CH) + "SELECT 'SNAPPY' AS codec, count(*)::BIGINT AS rows FROM charts",
        "summary_rows": with_(*CH) + """SELECT region, title, artist, strftime(date, '%Y-%m') AS month, count(*)::BIGINT AS appearances,
  sum(DISTINCT 1::BIGINT << day(date))::BIGINT AS days, min(rank)::INTEGER AS best_rank, sum(streams)::BIGINT AS streams
FROM charts WHERE day(date) % 2 = 1 OR month(date) % 2 = 0 GROUP BY ALL""",
        "summary_q1": with_(*CH, grown, Q1.replace("FROM charts", "FROM grown")) + "SELECT * FROM q1",
        "summary_q2": with_(*CH, grown, Q2.replace("FROM charts", "FROM grown")) + "SELECT * FROM q2",
        "summary_q3": with_(*CH, grown, SONG_YEAR.replace("FROM charts", "FROM grown"), Q3) + "SELECT * FROM q3",
        "stream_segments": with_(*CH) + "SELECT * FROM charts",
        "stream_ledger": with_(*BASE) + reasons("SELECT *, false AS bad FROM raw_charts") + "SELECT reason, count(*)::BIGINT AS rows FROM judged GROUP BY reason",
        "q2_day_sets": with_(*CH, Q2) + "SELECT * FROM q2",
        "rerun_changed_params": with_(*CH, Q2) + "SELECT * FROM q2",
        "q1_open_markets": with_(*CH, Q1) + "SELECT * FROM q1",
        "result_roundtrip": with_(*CH, Q1) + """SELECT CASE WHEN total_appearances % 5 <> 0 THEN title END AS title,
  CASE WHEN total_appearances % 3 <> 0 THEN artist END AS artist, num_countries, total_appearances FROM q1""",
        "noise_lines": _noise_lines(),
        "stream_clean": with_(*CH) + "SELECT * FROM charts",
        "stream_ingest_clean": with_(*CH) + "SELECT * FROM charts",
        "normalize_columns": with_(*BASE) + "SELECT date, region, chart, trend, rank, title, artist, streams, "
                                            "url AS track_url FROM raw_charts",
        "preview": with_(*CH) + "SELECT date, region, rank, title, artist, streams FROM charts "
                                "ORDER BY date, region, rank, title, artist, streams LIMIT 5",
        "region_normalize": with_(*BASE) + "SELECT r.region AS raw_region, COALESCE(m.code, r.region) AS region "
                                           f"FROM raw_charts r LEFT JOIN markets m "
                                           f"ON lower(trim(r.region, {WS})) = m.market_key",
        "type_cast": with_(*BASE) + f"""SELECT date AS raw_date, rank AS raw_rank, streams AS raw_streams,
  {PDATE} AS date, {whole("rank", "INTEGER")} AS rank,
  {whole("streams", "BIGINT")} AS streams, CAST(year({PDATE}) AS INTEGER) AS year
FROM (SELECT date, rank, CASE WHEN rank LIKE '%7' THEN streams || 'd' WHEN rank LIKE '%8' THEN '9007199254740993.0' WHEN rank LIKE '%9' THEN '0x1p3'
  ELSE streams END AS streams FROM raw_charts)""",
        "month_bucket": with_(*BASE) + f"SELECT date, strftime({PDATE}, '%Y-%m') AS month_str FROM raw_charts",
        "coerce_numeric": with_(*BASE) + """, odd AS (SELECT title, artist, CASE WHEN rank LIKE '%5' THEN 'x' || rank ELSE rank END AS rank,
  CASE WHEN streams IS NULL THEN 'n/a' WHEN rank LIKE '%0' THEN streams || 'f' ELSE streams END AS streams FROM raw_charts),
num AS (SELECT title, artist, TRY_CAST(rank AS DOUBLE) AS rank, TRY_CAST(streams AS DOUBLE) AS streams FROM odd)
SELECT * FROM num WHERE rank IS NOT NULL OR streams IS NOT NULL""",
        "label_text": f"SELECT doc_id, {label_sql('text', 28)} AS label, "
                      "regexp_replace(text, '[^\\x00-\\x7F]', '?', 'g') AS ascii_text FROM documents",
        "filter_chart": with_(*BASE) + f"SELECT {RAW_COLS} FROM raw_charts WHERE chart = 'top200'",
        "filter_years": with_(*BASE) + f"SELECT {RAW_COLS} FROM raw_charts "
                                       f"WHERE {PDATE} >= {YEAR_LO} AND {PDATE} < {YEAR_HI}",
        "filter_markets": with_(*BASE) + f"SELECT {RAW_COLS} FROM raw_charts "
                                         f"WHERE {KEY} IN (SELECT market_key FROM markets)",
        "lookup_market": with_(*BASE) + "SELECT r.*, m.code AS country_code FROM raw_charts r "
                                        f"JOIN markets m ON lower(trim(r.region, {WS})) = m.market_key",
        "lookup_display": with_(*all_typed) + """SELECT c.region, COALESCE(m.display, c.region) AS display, c.rows
FROM (SELECT region, CAST(COUNT(*) AS BIGINT) AS rows FROM all_valid GROUP BY region) c
LEFT JOIN markets m ON m.code = c.region""",
        "drop_incomplete": with_(*all_typed) + "SELECT * FROM all_complete",
        "filter_valid": with_(*all_typed) + "SELECT * FROM all_valid",
        "union_sources": with_(*CH) + "SELECT * FROM ingested",
        "ingest_charts": with_(*CH) + "SELECT * FROM ingested",
        "clean_charts": with_(*CH) + "SELECT * FROM charts",
        "clean_funnel": with_(*CH) + f"""SELECT CAST(COUNT(*) AS BIGINT) AS raw_rows,
  CAST(COUNT(*) FILTER (WHERE chart = 'top200') AS BIGINT) AS chart_rows,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM ingested) AS ingested_rows,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM ingested_complete) AS complete_rows,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM charts) AS clean_rows
FROM raw_charts""",
        "count_by_region": with_(*CH) + "SELECT region, CAST(COUNT(*) AS BIGINT) AS rows FROM charts "
                                        "GROUP BY region ORDER BY rows DESC, region",
        "distinct_markets": with_(*CH) + "SELECT DISTINCT region FROM charts ORDER BY region",
        "song_year_totals": with_(*CH, SONG_YEAR) + "SELECT * FROM song_year",
        "yearly_totals": with_(*CH, YEAR_TOTALS) + "SELECT * FROM year_totals",
        "q1_cross_market": with_(*CH, Q1) + "SELECT * FROM q1",
        "q2_longevity": with_(*CH, Q2) + "SELECT * FROM q2 ORDER BY region, days_on_chart DESC, title, artist",
        "q3_yearly_leader": with_(*CH, SONG_YEAR, YEAR_TOTALS, Q3) + "SELECT * FROM q3 ORDER BY year",
        "q3_yearly_leader_join": with_(*CH, SONG_YEAR, YEAR_TOTALS, Q3) + "SELECT * FROM q3 ORDER BY year",
        "series_cross_market": with_(*CH, Q1) + f"""SELECT
  CAST(ROW_NUMBER() OVER (ORDER BY num_countries DESC, total_appearances DESC, title, artist) AS INTEGER)
    AS position,
  title, artist, num_countries, total_appearances,
  {label_sql('artist', 20, False)} || '  -  ' || {label_sql('title', 28, False)} AS label,
  CASE num_countries {colors} ELSE '#A5D8FF' END AS color,
  'Charted in ' || num_countries || ' markets' AS legend
FROM q1 WHERE total_appearances % 4 <> 0""",
        "series_longevity": with_(*CH, Q2) + f"""SELECT m.ordinal, m.display AS country, q.region,
  CAST(ROW_NUMBER() OVER (PARTITION BY m.display ORDER BY q.days_on_chart DESC, q.title, q.artist) AS INTEGER)
    AS position,
  q.title, q.artist, q.days_on_chart, q.best_rank,
  {label_sql('q.title', 18)} || chr(10) || {label_sql('q.artist', 16)} AS label,
  CASE WHEN q.best_rank > 0 THEN '#' || q.best_rank END AS badge
FROM (SELECT region, title, artist, days_on_chart, CASE WHEN best_rank % 3 <> 0 THEN best_rank ELSE 0 END AS best_rank
      FROM q2 WHERE length(title) % 4 <> 0) q JOIN markets m ON m.code = q.region""",
        "series_yearly": with_(*CH, SONG_YEAR, YEAR_TOTALS, Q3) + f"""SELECT year, total_streams, streams_b,
  printf('%.2f', streams_b) || 'B' AS bar_text,
  CASE WHEN streams_b > 0.45 THEN {label_sql('title', 22)} || chr(10) || {label_sql('artist', 18)} END AS song_text
FROM (SELECT *, CAST(total_streams AS DOUBLE) / 10000.0 AS streams_b FROM q3 WHERE year <> 1997) t ORDER BY year""",
        "end_to_end_run": with_(*CH, Q2) + "SELECT * FROM q2",
        "quality_report": with_(*CH, Q1, Q2, SONG_YEAR, YEAR_TOTALS, Q3)
        + f"SELECT gate, rows, rows >= 1 AS passed FROM ({gate_q}) g",
    }
