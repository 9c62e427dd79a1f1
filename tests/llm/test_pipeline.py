import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from sigspark.llm import language, pieces

from .test_chat_secrets import brute_base, brute_entropy
from .test_jaccard import brute as brute_components
from .test_warc_media_contamination import brute as brute_contamination

DATA = "/root/testdata/sf0.001"


def masked(text, spans):
    out, at = [], 0
    for start, _, end, _ in sorted(spans):
        if start >= at:
            out.append(text[at:start])
        at = max(at, end)
    return "[SECRET]".join([*out, text[at:]])


def test_run_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    junk = spark.createDataFrame([(9001, "1234 5678 !!", "en", "src0", 12), (9002, "", "fr", "src1", 0), (9003, None, None, None, None)], docs.schema)
    docs.unionByName(junk).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in docs.collect()}

    left = {r.doc_id for r in language.identify_documents(docs).where("lang_keep").collect()}
    assert left == set(rows) - {9001, 9002, 9003}
    comps = brute_components([(i, rows[i].text) for i in sorted(left)])
    left = {d for d, _, c in comps if d == c}
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    left -= {d for d, *_, bad in brute_contamination([(i, rows[i].text) for i in sorted(left)], items) if bad}
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = {}
    for i in left:
        t = rows[i].text
        spans = brute_base(t)
        t = masked(t, spans + brute_entropy(t, spans))
        want[i] = (len(t), library.encode(t))

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_chars, r.token_ids) for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got)


def test_stages_keep_the_columns(spark):
    clash = ["runs", "spans", "items", "n_words", "contaminated", "lang_id", "_ll", "_host", "base_spans", "secret_spans", "token_ids", "round_trip", "component_id", "rep", "n", "row", "key1"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.col("doc_id") < 60).select("*", *(F.lit(c).alias(c) for c in clash))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.dtypes == docs.dtypes and all(r[c] == c for r in out.collect() for c in clash)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).where("round_trip").count() == docs.count()


def test_empty(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0


def test_repeated_rows_and_rows_without_an_id(spark, tmp_path):
    """Rows of one doc_id stay or go together; a row without an id is never a near duplicate of another."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.col("doc_id") < 40)
    once = docs.where("doc_id >= 30")
    nameless = docs.where("doc_id < 6").withColumn("doc_id", F.lit(None).cast("long"))
    docs.unionByName(once).unionByName(nameless).unionByName(nameless).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    spark.read.parquet(str(tmp_path / "documents.parquet")).dropDuplicates(["doc_id"]).where("doc_id IS NOT NULL").write.parquet(str(tmp_path / "once/documents.parquet"))
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(str(tmp_path / "once/benchmark.parquet"))
    single = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path / "once")).collect()}
    counts = {}
    for r in got:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert {d: n for d, n in counts.items() if d is not None} == {d: 1 + (d >= 30) for d in single}
    assert counts[None] == 2 * sum(d < 6 for d in single)
    assert all(r.token_ids == single[r.doc_id].token_ids for r in got if r.doc_id is not None)
