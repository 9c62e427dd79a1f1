"""What the physical plans must look like: pruned scans, pushed filters, few shuffles, no Python where none is needed."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.operators import ordered as O
from sigspark.operators import signals as S
from sigspark.plans import registry
from sigspark.sources import dat

from .test_sources import make

DATA = "/root/testdata/sf0.001"
WITH_PYTHON = {"greedy_refractory", "iir_first_order", "zero_phase_filter", "resample_channel", "ahrs_fusion", "dsp_cascade", "badpixel_median", "demosaic"}
#: Files in the engine's own formats are read and written by Python data sources; filters are designed by numpy.
WITH_PYTHON |= {"recording_files", "range_filter", "frame_files_read", "parameter_files", "wav_file", "filter_design", "dsp_modes", "dsp_hilbert"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_python_only_where_needed(spark, name):
    text = plan(registry.QUERIES[name](spark, DATA))
    assert bool(re.search("Python|Pandas|Arrow", text)) == (name in WITH_PYTHON)
    assert "CartesianProduct" not in text


@pytest.mark.parametrize(("name", "column"), [("digital_edges", "props"), ("interval_filter", "value"), ("column_median", "l_orderkey"), ("zip_truncate", "props"), ("fps_window", "value")])
def test_columns_are_pruned(spark, name, column):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan(registry.QUERIES[name](spark, DATA)))
    assert schemas and not any(column in s for s in schemas)


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,click)" in plan(registry.QUERIES["detect_only_anti"](spark, DATA))


def test_bits_are_expanded_after_the_shuffle(spark):
    words = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("sample_idx"), F.col("id").alias("word"))
    text = plan(O.word_edges(words, ["k"], "sample_idx", "word"))
    assert len(re.findall("Exchange hashpartitioning", text)) == 1
    assert text.index("Generate") < text.index("Exchange")


def test_byte_ranges_are_pruned(spark, tmp_path):
    path = make(f"{tmp_path}/s/a.dat", range(1000))
    df = dat.read_dat(spark, path, 1, frames_per_partition=10).where("sample_idx BETWEEN 105 AND 114")
    assert df.rdd.getNumPartitions() == 1 and df.count() == 10


def test_last_response_is_sought_over_all_ids(spark, tmp_path):
    rows = [(i, "ab"[i % 2], "view" if i in (10, 700, 801) else "click") for i in range(900)] + [(9, "c", "click"), (20, None, "click")]
    spark.createDataFrame(rows, "event_id long, user_id string, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = registry.QUERIES["stim_ready_by_user"](spark, str(tmp_path)).collect()
    last = {"a": 700, "b": 801}
    want = [(i, u) for i, u, kind in rows if kind == "click" and i >= last.get(u, 0)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(map(str, con.execute(registry.ORACLE["stim_ready_by_user"]).fetchall())) == sorted(map(str, want))


def test_no_task_gets_a_whole_channel(spark):
    """Filters and resampling group by key and chunk, and shuffle a channel's samples once."""
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one_scan = (S.resample(df, ["k"], "i", "v", 2, 25, first=0), S.zero_phase_filter(df, ["k"], "i", "v", 5, 1250))
        for out in (*one_scan, S.resample(df, ["k"], "i", "v", 2, 25)):
            text = plan(out)
            dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
            assert len([d for d in dealt if "_chunk" in d]) == 1
            assert "MapInArrow" in text and "FlatMapGroups" not in text
            # without a given start, a pass over the index finds it: a row for each channel is shuffled by key
            assert (text.count("Range (") == 1 and len(dealt) == 1) == any(out is o for o in one_scan)
            assert all("_chunk" in d or "partial_min" in text for d in dealt)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("make_plan", [lambda df: O.fir(df, ["k"], "i", "v", [1.0, 0.5]), lambda df: O.moving_average(df, ["k"], "i", "v", 4)])
def test_short_filters_window_over_chunks(spark, make_plan):
    df = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    assert re.search(r"hashpartitioning\([^)]*_chunk", plan(make_plan(df)))


@pytest.mark.parametrize("name", ["badpixel_median", "brightness_normalise", "demosaic", "hist_equalise", "rotate180"])
def test_pixels_are_scaled_in_the_precision_of_vectors(spark, tmp_path, name):
    """Single values whose product with 400 is a whole number in single precision and less than that in double."""
    edge = [float(v) for v in np.nextafter(np.arange(2, 600, dtype=np.float32) / np.float32(400), np.float32(0)) if np.float32(v) * np.float32(400) != np.floor(float(v) * 400)]
    edge += [float(np.float32(k) / np.float32(400)) for k in range(1, 600) if float(np.float32(k) / np.float32(400)) * 400 < k]
    rows = [(i, [(-1) ** k * edge[(i * 31 + k) % len(edge)] for k in range(64)]) for i in range(8)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = registry.QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE[name]}) q").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
