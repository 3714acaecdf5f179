"""DuckDB SQL oracles, one per registered query, over the raw parquet views.

The stand-in derivations are restated in SQL (not shared code), so the
check is independent of the Spark plan. DuckDB casts round where Spark's
truncate, hence the explicit ``trunc``.
"""

from __future__ import annotations

SONG_CTE = """
song AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS song_id,
         l_orderkey, l_partkey,
         CAST(1922 + floor(40*f1 + 25*f2 + 15*f3 + 8*f12) AS DOUBLE) AS year,
         f1, f2, f3, f4, f5, f6, f7, f8, f9, f10, f11, f12
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          l_quantity/50.0E0 AS f1, l_extendedprice/105000.0E0 AS f2, l_discount*10 AS f3,
          l_tax/0.08E0 AS f4, l_linenumber/7.0E0 AS f5,
          ((l_orderkey*13  + l_partkey*17)    % 1000)/1000.0E0 AS f6,
          ((l_orderkey*101 + l_suppkey*7)     % 1000)/1000.0E0 AS f7,
          ((l_partkey*211  + l_suppkey*3)     % 1000)/1000.0E0 AS f8,
          ((l_orderkey*307 + l_linenumber*11) % 1000)/1000.0E0 AS f9,
          ((l_partkey*401  + l_linenumber*23) % 1000)/1000.0E0 AS f10,
          ((l_orderkey*503 + l_partkey*29)    % 1000)/1000.0E0 AS f11,
          ((l_orderkey*7919 + l_partkey*104729 + l_suppkey*31) % 1000)/1000.0E0 AS f12
        FROM lineitem) t
),
typed AS (
  SELECT song_id, CAST(trunc(year) AS INTEGER) AS year, f1, f2, f3 FROM song
)"""

BANK_CTE = """
bank AS (
  SELECT CAST(18 + c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS job,
         'married' AS marital, 'secondary' AS education,
         CAST(trunc(c_acctbal) AS INTEGER) AS balance
  FROM customer
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + body


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


oracle("text_scan_count", "SELECT count(*) AS n FROM lineitem")
oracle("split_line", with_ctes(SONG_CTE, body="""
SELECT song_id, CAST(13 AS INTEGER) AS n_fields, year AS label FROM song"""))
oracle("song_typed", with_ctes(SONG_CTE, body="SELECT * FROM typed"))
oracle("song_count", with_ctes(SONG_CTE, body="SELECT count(*) AS n FROM typed"))
oracle("songs_1998_2000", with_ctes(SONG_CTE, body="""
SELECT count(*) AS n FROM typed WHERE year >= 1998 AND year <= 2000"""))
oracle("year_profile", with_ctes(SONG_CTE, body="""
SELECT max(year) AS max_year, min(year) AS min_year, avg(year) AS avg_year,
       CAST(sum(year) // count(year) AS BIGINT) AS avg_year_trunc
FROM typed"""))
oracle("songs_per_year", with_ctes(SONG_CTE, body="""
SELECT year, count(*) AS numberSongs FROM typed
WHERE year BETWEEN 2000 AND 2010 GROUP BY year"""))
oracle("first_rows", with_ctes(SONG_CTE, body="""
SELECT * FROM typed ORDER BY song_id, year, f1, f2, f3 LIMIT 5"""))
oracle("bank_parse", with_ctes(BANK_CTE, body="SELECT * FROM bank"))
oracle("bank_age_counts", with_ctes(BANK_CTE, body="""
SELECT age, count(1) AS cnt FROM bank WHERE age < 70 GROUP BY age ORDER BY age"""))


oracle("bank_csv_age_counts", ORACLES["bank_age_counts"])
oracle("landed_songs_per_year", ORACLES["songs_per_year"])
for _n in ("song_count", "songs_1998_2000", "songs_per_year", "bank_age_counts"):
    oracle("sql_" + _n, ORACLES[_n])
oracle("sql_year_profile", with_ctes(SONG_CTE, body="""
SELECT max(year) AS max_year, min(year) AS min_year, avg(year) AS avg_year FROM typed"""))


oracle("reject_counts", """
SELECT count(*) AS n, count(*) FILTER (WHERE y OR x) AS rejected, count(*) FILTER (WHERE y) AS bad_year,
       count(*) FILTER (WHERE x) AS bad_f1, CAST(0 AS BIGINT) AS bad_f2, CAST(0 AS BIGINT) AS bad_f3
FROM (SELECT l_orderkey % 7 = 0 AS y, l_linenumber % 5 = 0 AS x FROM lineitem)""")


REJECT_CTE = """
checked AS (SELECT song_id, year, l_orderkey % 7 = 0 AS y, CAST(split_part(song_id, '-', 2) AS INTEGER) % 5 = 0 AS x FROM song)"""
oracle("landed_songs_and_rejects", with_ctes(SONG_CTE, REJECT_CTE, body="""
SELECT 'accepted' AS kind, count(*) AS n, CAST(sum(year) AS BIGINT) AS years FROM checked WHERE NOT (x OR y)
UNION ALL SELECT 'rejected', count(*), NULL FROM checked WHERE x OR y
UNION ALL SELECT 'year is not a number', count(*), NULL FROM checked WHERE y
UNION ALL SELECT 'f1 is not a number', count(*), NULL FROM checked WHERE x"""))
oracle("rejected_lines", with_ctes(SONG_CTE, REJECT_CTE, body="""
SELECT song_id, concat_ws('; ', CASE WHEN y THEN 'year is not a number' END, CASE WHEN x THEN 'f1 is not a number' END) AS reasons,
  CASE WHEN y THEN 'n/a' ELSE CAST(year AS VARCHAR) END AS first_field
FROM checked WHERE x OR y"""))


def oracle_sql() -> dict[str, str]:
    from . import oracles_io, oracles_ml, oracles_vec  # noqa: F401
    return dict(ORACLES)
