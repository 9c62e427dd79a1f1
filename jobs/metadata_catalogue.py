"""Metadata catalogue: an incremental inventory of markup files.

    python -m jobs.metadata_catalogue --source FOLDER --out PATH --checkpoint PATH [--current PATH] [--config FILE]

Follows a folder to which Parquet files of (page_id, url, html) are added, or
tables that are folders of such files: a file stream takes, at each run, the
files that have come since the checkpoint of the run before, and ends. The
pattern is for the names of the files or tables in the folder. Each text is scanned whole for its metadata
(title, language, rate and number of channels where it is an acquisition
file, tags counted by name) and gets a row in Parquet partitioned by batch
and language:

    page_id, url, host, title, n_channels, fs, n_tags, tag_counts, n_chars, html_sha256, batch, lang

A text that the catalogue has already under the same id, url and digest is not
added again, be it delivered twice in a file, in two files or after the
checkpoint was lost; a text that has changed is a further row, and
``current`` gives the latest of each id and url, which ``--current`` writes
out, partitioned by language, when a run has brought something new. A batch that is repeated after a
failure replaces its own partitions with the same rows, so that a rerun leaves
the same catalogue. Null html has no metadata, and a row; a null id is an id.
"""

from __future__ import annotations

import argparse
import json
import logging
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.operators.joins import same_keys

log = logging.getLogger("metadata_catalogue")
CONFIG = Path(__file__).with_suffix(".json")
SOURCE_SCHEMA = "page_id long, url string, html string"
SCHEMA = "page_id long, url string, host string, title string, n_channels int, fs int, n_tags long, tag_counts array<long>, n_chars long, html_sha256 string, batch long, lang string"
#: What makes two rows the same text of the same file.
SAME = ["page_id", "url", "html_sha256"]


def read_config(path: str | Path = CONFIG) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def described(pages: DataFrame, tags: list[str]) -> DataFrame:
    """Metadata of pages(page_id, url, html): one pass over each text, no Python."""
    # every pattern stops at the next < or >, so that broken markup takes no longer than whole markup
    head = F.regexp_extract("html", r"(?i)<html[^<>]*+>", 0)
    lang = F.lower(F.regexp_extract(head, r"(?i)\slang=[\"']?([a-z-]+)", 1))
    counts = F.array(*(F.coalesce(C.xml_count("html", t), F.lit(0).cast("long")) for t in tags))
    return pages.select(
        "page_id",
        "url",
        F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit("")).alias("host"),
        F.nullif(C.xml_text("html", "title"), F.lit("")).alias("title"),
        C.xml_number("html", "nChannels").alias("n_channels"),
        C.xml_number("html", "samplingRate").alias("fs"),
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tags"),
        counts.alias("tag_counts"),
        F.coalesce(F.length("html"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2("html", 256).alias("html_sha256"),
        F.coalesce(F.nullif(lang, F.lit("")), F.lit("none")).alias("lang"),
    )


def read_catalogue(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(out)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def current(catalogue: DataFrame) -> DataFrame:
    """Of each page_id and url, the row that came last."""
    w = W.partitionBy("page_id", "url").orderBy(F.desc("batch"), F.desc("html_sha256"))
    return catalogue.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _add(found: DataFrame, batch: int, out: str, said: dict) -> None:
    """The rows of one batch that no other batch has, into the batch's own partitions."""
    spark = found.sparkSession
    rows = found.dropDuplicates(SAME)
    if _exists(spark, out):
        known = read_catalogue(spark, out).where(F.col("batch") != batch).select(*SAME)
        rows = same_keys(rows, known, SAME, "left_anti")
    rows = rows.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance", "lang")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "lang").parquet(out)
    read, written = found.count(), read_catalogue(spark, out).where(F.col("batch") == batch).count()
    said["batches"] += 1
    said["read"] += read
    said["written"] += written
    log.info("batch %d: read %d pages, wrote %d new ones to %s", batch, read, written, out)


def run(spark: SparkSession, source: str, out: str, checkpoint: str, config: dict, latest: str | None = None) -> dict:
    """Take the files that are new since the checkpoint; returns when all are in the catalogue, and its latest rows at ``latest``."""
    said = {"batches": 0, "read": 0, "written": 0}
    # matched anew at each trigger: a file is taken by itself, a table by the files that it has
    pages = spark.readStream.schema(SOURCE_SCHEMA).option("maxFilesPerTrigger", int(config["files_per_batch"])).parquet(f"{source.rstrip('/')}/{config['pattern']}")
    writer = described(pages, config["tags"]).writeStream.foreachBatch(lambda df, batch: _add(df, batch, out, said))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d pages in %d batches of %s, wrote %d", said["read"], said["batches"], source, said["written"])
    if latest and (said["batches"] or not _exists(spark, latest)):
        current(read_catalogue(spark, out)).hint("rebalance", "lang").write.mode("overwrite").partitionBy("lang").parquet(latest)
        log.info("wrote the latest rows to %s", latest)
    return said


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Add the metadata of new markup files to a catalogue.")
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--current")
    p.add_argument("--config", default=CONFIG)
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("metadata_catalogue").getOrCreate()
    try:
        run(spark, a.source, a.out, a.checkpoint, read_config(a.config), a.current)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
