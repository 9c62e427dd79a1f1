"""The jobs as queries over the given tables: each runs twice into a new folder, and what then stands there is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import closed_loop_audit, metadata_catalogue
from sigspark.sources.shared import fresh_folder

AUDIT, CATALOGUE = closed_loop_audit.read_config(), metadata_catalogue.read_config()


def job1_closed_loop_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_folder(spark, "job1")
    for _ in range(2):
        closed_loop_audit.run(spark, f"{sf_dir}/events.parquet", out, AUDIT)
    return closed_loop_audit.read_output(spark, out)


def job2_metadata_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "job2")
    for _ in range(2):
        metadata_catalogue.run(spark, sf_dir, f"{folder}/catalogue", f"{folder}/checkpoint", CATALOGUE)
    found = metadata_catalogue.read_catalogue(spark, f"{folder}/catalogue")
    return found.withColumn("tag_counts", F.array_join(F.transform("tag_counts", lambda n: n.cast("string")), ","))


JOB1_SQL = f"""
WITH d AS (SELECT user_id, event_id, epoch_us(ts) AS t, CAST(ts AS DATE) AS day FROM events WHERE event_type = '{AUDIT["detect"]}' AND ts IS NOT NULL),
g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS gap_any, t - lag(t) OVER (PARTITION BY user_id, day ORDER BY t, event_id) AS gap_us FROM d),
k AS (SELECT * FROM g WHERE gap_any IS NULL OR gap_any > {AUDIT["gap_s"] * 1_000_000}),
s AS (SELECT user_id, epoch_us(ts) AS t FROM events WHERE event_type = '{AUDIT["deliver"]}' AND ts IS NOT NULL),
m AS (SELECT k.*, CASE WHEN s.t - k.t <= {AUDIT["window_s"] * 1_000_000} THEN s.t END AS stim_us FROM k ASOF LEFT JOIN s ON k.user_id = s.user_id AND k.t <= s.t)
SELECT user_id, event_id, t AS t_us, gap_us, stim_us, stim_us - t AS latency_us, CASE WHEN stim_us IS NULL THEN 'detected_only' ELSE 'closed' END AS outcome,
  printf('%.6f', (t - epoch_us(CAST(day AS TIMESTAMP))) / 1e6 * 1000.0) || chr(9) || CASE WHEN stim_us IS NULL THEN 'Detect' ELSE 'StimOn' END || ' start 1' AS line, day
FROM m
"""

_COUNTS = [f"len(regexp_extract_all(coalesce(html, ''), '(?i)<{t}>'))" for t in CATALOGUE["tags"]]

JOB2_SQL = f"""
SELECT DISTINCT page_id, url, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1), '') AS host, nullif(regexp_extract(html, '(?i)<title>([^<]*)</title>', 1), '') AS title,
  TRY_CAST(regexp_extract(html, '(?i)<nChannels>\\s*(-?[0-9]+)\\s*</nChannels>', 1) AS INTEGER) AS n_channels, TRY_CAST(regexp_extract(html, '(?i)<samplingRate>\\s*(-?[0-9]+)\\s*</samplingRate>', 1) AS INTEGER) AS fs,
  CAST({" + ".join(_COUNTS)} AS BIGINT) AS n_tags, {" || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in _COUNTS)} AS tag_counts, coalesce(length(html), 0) AS n_chars, sha256(html) AS html_sha256, CAST(0 AS BIGINT) AS batch,
  coalesce(nullif(lower(regexp_extract(regexp_extract(html, '(?i)<html[^<>]*>'), '(?i)\\slang=["'']?([a-z-]+)', 1)), ''), 'none') AS lang
FROM pages
"""

QUERIES = {"job1_closed_loop_audit": job1_closed_loop_audit, "job2_metadata_catalogue": job2_metadata_catalogue}
ORACLE = {"job1_closed_loop_audit": JOB1_SQL, "job2_metadata_catalogue": JOB2_SQL}
