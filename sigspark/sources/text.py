"""Event lists and acquisition metadata: text scans and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.operators import events as E


LFP_RATE = 1250


def samples_in(n_bytes: Column, nch: Column) -> Column:
    """Whole frames of 16-bit samples in so many bytes."""
    return F.floor(n_bytes / (2 * nch)).cast("long")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """(path, time, description, kind, phase, channel) of event files; a missing one is an error."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value").where("value <> ''")
    return E.from_text(lines, keep=["path"])


def write_events(events: DataFrame, path: str) -> None:
    """events(time, description) in order of time; an existing path is an error."""
    E.to_text(events.orderBy("time")).write.mode("errorifexists").text(path)


def write_sessions(events: DataFrame, path: str, session: str) -> None:
    """events(session, time, description) as lines of event files behind their session's name (without tabs; none for a null): many short sessions share a file."""
    line = F.concat(F.coalesce(F.col(session).cast("string"), F.lit("")), F.lit("\t"), C.event_line("time", "description"))
    events.select(session, line.alias("value")).hint("rebalance", session).select("value").write.text(path)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """(session, time, description, kind, phase, channel) of what ``write_sessions`` wrote."""
    at = F.instr("value", "\t")
    lines = spark.read.text(path).where("value <> ''").select(F.nullif(F.substring("value", F.lit(1), at - 1), F.lit("")).alias("session"), F.substring("value", at + 1, F.length("value")).alias("value"))
    return E.from_text(lines, keep=["session"])


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_channels, fs, good_ch, ch_sel) of acquisition XML files."""
    xml = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))
    return xml.select("path", C.xml_number("xml", "nChannels").alias("n_channels"), C.xml_number("xml", "samplingRate").alias("fs"), C.xml_channels("xml", True).alias("good_ch"), C.xml_channels("xml", False).alias("ch_sel"))


def with_selection(metadata: DataFrame, selection: DataFrame | None = None, times: DataFrame | None = None) -> DataFrame:
    """metadata with a sidecar's channel selection in place of its own, and with its time selection."""
    out = metadata
    if selection is not None:
        out = out.join(selection.withColumnRenamed("ch_sel", "_sel"), "path", "left").withColumn("ch_sel", F.coalesce("_sel", "ch_sel")).drop("_sel")
    if times is not None:
        out = out.join(times, "path", "left")
    return out


def recordings(spark: SparkSession, path: str, xml: str) -> DataFrame:
    """(path, n_samples, n_channels, fs, good_ch, ch_sel) of recordings: sizes of the files and the XML of the same name beside them.

    A recording without XML keeps its row, with nulls; an .lfp file's rate is 1250.
    """
    sizes = spark.read.format("binaryFile").load(path).select("path", "length")
    stem = lambda c: F.regexp_replace(F.regexp_replace(c, r"^file:/+", "/"), r"\.[^./]*$", "")
    meta = read_metadata(spark, xml).withColumn("_stem", stem("path")).drop("path")
    out = sizes.withColumn("_stem", stem("path")).join(meta, "_stem", "left")
    rate = F.when(F.col("n_channels").isNotNull(), F.when(F.col("path").endswith(".lfp"), LFP_RATE).otherwise(F.col("fs")))
    return out.select("path", samples_in(F.col("length"), F.col("n_channels")).alias("n_samples"), "n_channels", rate.alias("fs"), "good_ch", "ch_sel")


def read_viewer(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """(path, start_time, duration, until, offsets) of a viewer's state: it shows [start_time, until].

    The duration is read from its own tag; compat takes the start for it, as the tool did.
    """
    nrs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))
    offsets = F.transform(F.regexp_extract_all("xml", F.lit(r"(?i)<offset>(-?[0-9]+)<"), F.lit(1)), lambda m: m.cast("int"))
    return nrs.select("path", C.xml_number("xml", "startTime").cast("long").alias("start_time"), C.xml_number("xml", "startTime" if compat else "duration").cast("long").alias("duration"), offsets.alias("offsets")).select("path", "start_time", "duration", (F.col("start_time") + F.col("duration")).alias("until"), "offsets")


def sample_counts(spark: SparkSession, path: str, nch: int) -> DataFrame:
    """(path, n_samples, fs) of 16-bit recordings, from their sizes."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.select("path", samples_in(F.col("length"), F.lit(nch)).alias("n_samples"), F.when(F.col("path").endswith(".lfp"), LFP_RATE).alias("fs"))
