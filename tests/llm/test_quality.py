import numpy as np
from pyspark.sql import functions as F

from sigspark.llm import quality

DATA = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    half = F.pmod("doc_id", F.lit(2)) == 0
    model = quality.fit(docs, labels.where(half))
    got = quality.classify(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), model)
    held = got.join(labels.where(~half), "doc_id")
    n = held.count()
    assert held.where((F.col("quality_posterior") >= 0.5) == (F.col("quality") == 1)).count() / n > 0.97
    assert held.where((F.col("toxic_posterior") >= 0.5) == (F.col("toxic") == 1)).count() / n > 0.97


def test_sparse_sites_are_shrunk(spark):
    rows = [(i, "big", "big/a", 2.0, -3.0) for i in range(400)] + [(1000 + i, "bad", "bad/a", -2.0, -3.0) for i in range(400)]
    rows += [(2000, "one", "one/a", -2.0, -3.0), (2001, None, None, 0.5, -3.0), (2002, "big", None, 2.0, -3.0)]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, quality_own double, toxic_own double")
    got = {r.doc_id: r for r in quality.posteriors(df).collect()}
    assert len(got) == len(rows)
    p = lambda x: 1 / (1 + np.exp(-x))
    assert got[0].quality_posterior > p(2.0) and got[1000].quality_posterior < p(-2.0)
    assert abs(got[2000].quality_posterior - p(-2.0)) < abs(got[1000].quality_posterior - p(-2.0)) + 0.02
    assert abs(got[2001].quality_posterior - p(0.5)) < 1e-9


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word " * 100_000, "x"), (3, "again", None), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (3, 1, 0), (9, None, 0)], LABELS)
    assert quality.classify(docs, labels, F.col("host"), F.col("host")).count() == len(rows)
    assert quality.classify(docs, labels.limit(0), F.col("host"), F.lit(None)).count() == len(rows)
    assert quality.classify(docs.limit(0), labels, F.col("host"), F.lit(None)).count() == 0
