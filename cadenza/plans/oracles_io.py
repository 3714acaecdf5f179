"""SQL oracles for archives and nested records."""

from __future__ import annotations

from .oracles import SONG_CTE, oracle, with_ctes
from .oracles_ml import R, enet_sql, rd

oracle("archive_members", """
SELECT page_id, CAST(strlen(html) AS BIGINT) AS size FROM pages""")
oracle("archive_content_hash", "SELECT page_id, md5(html) AS md5 FROM pages")
oracle("archive_segments_hash", "SELECT page_id, CAST(strlen(html) AS BIGINT) AS size, md5(html) AS md5 FROM pages")
oracle("archive_counts", """
SELECT 'pages-' || CAST(page_id // 100 AS VARCHAR) || '.tar.gz' AS archive,
       count(*) AS n, CAST(sum(strlen(html)) AS BIGINT) AS bytes
FROM pages GROUP BY 1""")

# raw nested values (NaN and unknown years included), flattened
RAW_REC_CTE = """
raw AS (
  SELECT song_id,
    CAST(CASE WHEN l_partkey % 13 = 0 THEN 0 ELSE trunc(year) END AS DOUBLE) AS year,
    CASE WHEN l_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE f1 END AS danceability,
    f2 AS duration, f3 AS end_of_fade_in, f4 AS energy, f5 AS key_confidence,
    f6 AS loudness, f7 AS mode_confidence, f8 AS start_of_fade_out, f9 AS tempo,
    f10 AS time_signature_confidence, f11 AS artist_familiarity, f12 AS artist_hotttnesss,
    CASE WHEN l_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE f4 END AS artist_latitude,
    CASE WHEN l_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE f5 END AS artist_longitude,
    f6 AS song_hotttnesss
  FROM song
),
rec AS (
  SELECT song_id, year,
    CASE WHEN isnan(danceability) THEN 0 ELSE danceability END AS danceability,
    duration, end_of_fade_in, energy, key_confidence, loudness, mode_confidence,
    start_of_fade_out, tempo, time_signature_confidence, artist_familiarity, artist_hotttnesss,
    CASE WHEN isnan(artist_latitude) THEN 0 ELSE artist_latitude END AS artist_latitude,
    CASE WHEN isnan(artist_longitude) THEN 0 ELSE artist_longitude END AS artist_longitude,
    song_hotttnesss
  FROM raw
)"""

oracle("flatten_record", with_ctes(SONG_CTE, RAW_REC_CTE, body="SELECT * FROM rec"))
oracle("nan_to_zero", with_ctes(SONG_CTE, RAW_REC_CTE, body=f"""
SELECT n, nan_danceability, nan_latitude, sum_danceability, sum_longitude FROM
  (SELECT count(*) AS n, count(*) FILTER (WHERE isnan(danceability)) AS nan_danceability,
          count(*) FILTER (WHERE isnan(artist_latitude)) AS nan_latitude FROM raw),
  (SELECT {rd('sum(danceability)', 'sum_danceability')},
          {rd('sum(artist_longitude)', 'sum_longitude')} FROM rec)"""))
oracle("known_year", with_ctes(SONG_CTE, RAW_REC_CTE, body="""
SELECT count(*) AS n, sum(year) AS sum_year, min(year) AS min_year FROM rec WHERE year <> 0"""))

REC_SPLIT_CTE = """
rtrain AS MATERIALIZED (
  SELECT *, year - 1922 AS y FROM rec
  WHERE year <> 0 AND ('0x' || substr(md5(song_id), 1, 8))::BIGINT % 100 < 80),
rtest AS MATERIALIZED (
  SELECT *, year - 1922 AS y FROM rec
  WHERE year <> 0 AND ('0x' || substr(md5(song_id), 1, 8))::BIGINT % 100 >= 80)"""
XR = ["danceability", "duration", "end_of_fade_in", "energy", "key_confidence"]
ENR = enet_sql(XR, "rtrain", [], "1.2E0", 20)
oracle("record_enet_coefficients", with_ctes(SONG_CTE, RAW_REC_CTE, REC_SPLIT_CTE, ENR, body=f"""
SELECT term, CASE WHEN value = 0 THEN 0.0E0 ELSE round(value, {R}) END AS value FROM (
  SELECT unnest(['intercept', 'x1', 'x2', 'x3', 'x4', 'x5']) AS term,
         unnest([c0, c1, c2, c3, c4, c5]) AS value FROM coef)"""))
_pred = "c0 + " + " + ".join(f"c{j + 1}*{x}" for j, x in enumerate(XR))
oracle("record_enet_test_rmse", with_ctes(SONG_CTE, RAW_REC_CTE, REC_SPLIT_CTE, ENR, body=f"""
SELECT {rd(f'sqrt(avg((y - ({_pred}))^2))', 'rmse')} FROM rtest, coef"""))

oracle("nested_flat", with_ctes(SONG_CTE, RAW_REC_CTE, body="SELECT * REPLACE (CAST(year AS INTEGER) AS year) FROM raw"))
SEGMENTS_CTE = """
seg AS (SELECT song_id, l_orderkey % 9 = 0 AS none, CAST(split_part(song_id, '-', 2) AS INTEGER) % 4 AS n, f2, f3, f4 FROM song),
each AS (SELECT *, unnest(CASE WHEN none OR n = 0 THEN [NULL] ELSE range(1, n + 1) END) AS i FROM seg)"""
oracle("nested_segments", with_ctes(SONG_CTE, SEGMENTS_CTE, body="""
SELECT song_id, CAST(i - 1 AS INTEGER) AS segments_pos, i * f3 AS start, i * f4 AS low, i + f2 AS value FROM each"""))
oracle("nested_beats", with_ctes(SONG_CTE, SEGMENTS_CTE, body="""
SELECT song_id, CAST(i - 1 AS INTEGER) AS segments_pos, CAST(k - 1 AS INTEGER) AS beats_pos, k * f2 AS beats
FROM (SELECT *, unnest(range(1, i)) AS k FROM each WHERE i IS NOT NULL)"""))
