import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sigspark.llm import language

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source")
    half = F.pmod("doc_id", F.lit(2)) == 0
    model = language.TextModel.fit(docs.where(half), "text", "lang")
    held = language.identify(docs.where(~half), declared=F.lit(None), host=F.col("source"), model=model)
    assert held.where("lang = lang_text").count() / held.count() > 0.97
    assert held.where("lang = lang_id").count() / held.count() > 0.97
    assert held.where("lang_keep").count() / held.count() > 0.99


def test_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = language.identify_pages(pages)
    assert got.columns[:3] == ["page_id", "url", "html"] and got.count() == pages.count()
    declared = language.markup_language(F.col("html"))
    assert got.where(declared == F.col("lang_id")).count() / got.where(declared.isNotNull()).count() > 0.9


def test_fusion_follows_host_and_declaration(spark):
    rows = [(i, "the cat and the dog " * 4, "en", "a") for i in range(40)] + [(100 + i, "le chat et le chien " * 4, "fr", "b") for i in range(40)]
    rows += [(200, "et", None, "b"), (201, None, "en", "a"), (202, "  123 ...", "en", None), (203, "the le " * 60_000, "??", None), (204, "", "fr", "b"), (204, "", "fr", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify_documents(df).collect()}
    assert got[200].lang_id == "fr" and got[0].lang_id == "en"
    for i in (201, 202, 204):
        assert got[i].lang_id == "und" and not got[i].lang_keep
    assert language.identify_documents(df).count() == len(rows)


@pytest.mark.parametrize("rows", [[], [(1, "no label", None, None)]])
def test_without_labels(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [(r.lang_id, r.lang_keep) for r in language.identify_documents(df).collect()] == [("und", False)] * len(rows)


RARE = ["hundurinn og kötturinn hlaupa yfir túnið", "stúlkan les bókina við gluggann", "veðrið er gott og sólin skín", "við förum í búðina á morgun"]


def test_rare_language_keeps_its_class_as_the_table_grows(spark):
    """The floor is five rows of the whole table, however large another language is."""
    common = spark.range(40_000).select("id", F.concat(F.lit("the cat and the dog run over the hill number "), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"))
    rare = spark.createDataFrame([(100_000 + i, f"{RARE[i % 4]} {i}", "is" if i < 6 else None, "b") for i in range(8)], "id long, text string, lang string, source string")
    got = language.identify_documents(common.unionByName(rare)).groupBy("source", "lang_id", "lang_keep").count().collect()
    assert sorted(tuple(r) for r in got) == [("a", "en", True, 40_000), ("b", "is", True, 8)]


def test_language_beyond_the_most_is_und(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    texts = [("en", "the cat and the dog", 30), ("fr", "le chat et le chien", 20), ("is", RARE[0], 10), ("xx", "the cat and the dog", 1)]
    rows = [(f"{lang}{i}", f"{text} {i}", lang, None) for lang, text, n in texts for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    got = language.identify_documents(df).groupBy("lang", "lang_id", "lang_keep").count().collect()
    assert sorted(tuple(r) for r in got) == [("en", "en", True, 30), ("fr", "fr", True, 20), ("is", "und", False, 10), ("xx", "en", True, 1)]


def test_rows_of_one_draw_leave_no_language_out(spark, monkeypatch):
    """Copies of one row share their draw: one of the least draw is taken all the same."""
    monkeypatch.setattr(language, "SAMPLE_ROWS", 2)
    rows = [(1, f"{text}", lang, "a") for lang, text in [("en", "the cat and the dog"), ("fr", "le chat et le chien"), ("is", RARE[0])] for _ in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert language.identify_documents(df).where("lang = lang_text").count() == 150


def test_registered_query_reads_markup_suffix_host_and_domain(spark, tmp_path):
    rows = [(i, f"http://w{i}.one.co/en/{i}", '<html lang="en"><p>the cat and the dog') for i in range(40)]
    rows += [(100 + i, f"http://w{i}.deux.fr/{i}", "<html lang='fr'><p>le chat et le chien") for i in range(40)]
    unclear = "<p>0 zq 0"  # trigrams of neither language
    rows += [(200, "http://new.deux.fr/", unclear), (201, "http://new.one.co/en/", unclear), (202, "http://x.y.fr/", unclear), (203, "http://x.y.z/en/", unclear), (204, None, f"<html lang=fr>{unclear}"), (205, None, f"<html lang=en>{unclear}"), (206, "http://w0.deux.fr/", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in entry.queries()["op7_language_id_pages"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        assert (got[i].lang, got[i].lang_id, got[100 + i].lang, got[100 + i].lang_id) == ("en", "en", "fr", "fr")
    assert [got[i].lang_id for i in range(200, 206)] == ["fr", "en"] * 3
    assert (got[206].lang_id, got[206].keep) == ("und", False)


def brute(rows, model, folds):
    """The fused decision of rows (key, text, declared, suffix, host, parent) in plain Python: key -> (language, posterior, text-only language)."""
    names, k = model.languages, len(model.languages)
    lls = dict(zip((r[0] for r in rows), model.score([None if r[1] is None else r[1].encode() for r in rows], [folds[r[0]] for r in rows]), strict=True))
    best = {key: max(range(k), key=ll.__getitem__) for key, ll in lls.items() if ll is not None}

    def counts(at):
        out = {}
        for r in rows:
            if r[0] in best and r[at] is not None:
                out.setdefault(r[at], [0] * k)[best[r[0]]] += 1
        return out

    pull = lambda n, base, weight: [(x + weight * b) / (sum(n) + weight) for x, b in zip(n, base, strict=True)]
    whole = [1 + sum(b == i for b in best.values()) for i in range(k)]
    corpus = [x / sum(whole) for x in whole]
    parents = {p: pull(n, corpus, language.PARENT_WEIGHT) for p, n in counts(5).items()}
    above = {r[4]: parents.get(r[5], corpus) for r in rows if r[0] in best}
    hosts = {h: pull(n, above[h], language.HOST_WEIGHT) for h, n in counts(4).items()}
    cues = [{v: pull(n, corpus, language.CUE_WEIGHT) for v, n in counts(at).items()} for at in (2, 3)]
    out = {}
    for key, _, declared, suffix, host, _ in rows:
        if key not in best:
            out[key] = ("und", 0.0, "und")
            continue
        said = [cue.get(v, corpus) for cue, v in zip(cues, (declared, suffix), strict=True)]
        logs = [lls[key][i] + math.log(hosts.get(host, corpus)[i]) + sum(math.log(s[i] / corpus[i]) for s in said) for i in range(k)]
        top = max(logs)
        out[key] = (names[logs.index(top)], 1 / sum(math.exp(x - top) for x in logs), names[best[key]])
    return out


def same(got, want):
    assert set(got) == set(want)
    for key, (lang, posterior, text) in want.items():
        assert (got[key].lang_id, got[key].lang_text) == (lang, text)
        assert got[key].lang_posterior == pytest.approx(posterior, abs=2e-6)


def test_op7_equals_brute_force(spark):
    small = DATA.replace("0.01", "0.001")
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source")
    cues = docs.select("*", F.col("lang").alias("_declared"), F.lit(None).cast("string").alias("_suffix"), F.col("source").alias("_host"), F.lit(None).cast("string").alias("_parent"))
    model = language.TextModel.fit(cues, "text", "_declared")
    folds = dict(docs.select("doc_id", language.fold_of(F.col("text"))).collect())
    want = brute([(r.doc_id, r.text, r.lang, None, r.source, None) for r in docs.collect()], model, folds)
    got = {r.doc_id: r for r in entry.queries()["op7_language_id"](spark, small).collect()}
    same(got, want)
    assert all(r.keep == (r.lang_id != "und" and r.lang_posterior >= 0.5) for r in got.values())


def test_all_evidence_equals_brute_force(spark):
    texts = ["the cat and the dog", "le chat et le chien", "zq", "et", "the", None, "12"]
    rows = [(i, texts[(i * 5 + i // 7) % 7], ["en", "fr", None, "en"][i % 4], ["fr", "uk", None][i % 3], f"h{i % 5}" if i % 6 else None, ["p0", "p1", None][i % 5 % 3] if i % 6 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, d string, s string, h string, p string")
    model = language.TextModel.fit(df, "text", "d")
    got = language.identify(df, "text", F.col("d"), F.col("s"), F.col("h"), F.col("p"), model)
    same({r.id: r for r in got.collect()}, brute(rows, model, dict(df.select("id", language.fold_of(F.col("text"))).collect())))


def test_a_text_is_scored_by_the_other_fold(spark):
    """A language whose every text has its own words: its rows are known by the other fold's only, copies share a fold."""
    words = ["alfa", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliett"]
    rows = [(i, f"{words[i % 10]} {words[i % 10]}", "ab"[i % 10 // 5]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = language.TextModel.fit(df, "text", "lang")
    folds = dict(df.select("text", language.fold_of(F.col("text"))).distinct().collect())
    assert len(folds) == 10 and set(folds.values()) == {0, 1}
    for text, fold in folds.items():
        bucket = language.trigram_buckets(text[:3].encode())
        own, other = (model.weights[f][bucket][0] for f in (fold, 1 - fold))
        assert own.max() < other.max()


def test_fused_posterior_by_sql(spark):
    """The fusion step over a table of scores, in SQL."""
    import duckdb

    rows = [(i, ["the cat and the dog", "le chat et le chien", "zq et"][i % 3], ["en", "fr", None][i % 5 % 3], ["h0", "h1", None][i % 7 % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, text string, d string, h string")
    model = language.TextModel.fit(df, "text", "d")
    assert model.languages == ["en", "fr"]
    got = {r.id: r for r in language.identify(df, "text", F.col("d"), None, F.col("h"), None, model).collect()}
    folds = dict(df.select("id", language.fold_of(F.col("text"))).collect())
    lls = model.score([r[1].encode() for r in rows], [folds[r[0]] for r in rows])
    con = duckdb.connect()
    con.execute("CREATE TABLE s(id BIGINT, d VARCHAR, h VARCHAR, k INTEGER, ll DOUBLE)")
    con.executemany("INSERT INTO s VALUES (?, ?, ?, ?, ?)", [(r[0], r[2], r[3], k, v) for r, ll in zip(rows, lls, strict=True) for k, v in enumerate(ll)])
    want = con.execute(f"""
        WITH b AS (SELECT id, d, h, arg_min(k, (-ll, k)) AS best FROM s GROUP BY id, d, h),
        l AS (SELECT DISTINCT k FROM s),
        c AS (SELECT k, (1 + count(best)) / (2.0 + (SELECT count(*) FROM b)) AS p FROM l LEFT JOIN b ON best = k GROUP BY k),
        hp AS (SELECT h, k, (count(*) FILTER (best = k) + {language.HOST_WEIGHT} * any_value(p)) / (count(*) + {language.HOST_WEIGHT}) AS q FROM b, c WHERE h IS NOT NULL GROUP BY h, k),
        dp AS (SELECT d, k, (count(*) FILTER (best = k) + {language.CUE_WEIGHT} * any_value(p)) / (count(*) + {language.CUE_WEIGHT}) AS q FROM b, c WHERE d IS NOT NULL GROUP BY d, k),
        f AS (SELECT s.id, s.k, s.ll + ln(coalesce(hp.q, c.p)) + coalesce(ln(dp.q / c.p), 0) AS x FROM s JOIN c USING (k) LEFT JOIN hp USING (h, k) LEFT JOIN dp USING (d, k))
        SELECT id, arg_max(k, x), max(exp(x)) / sum(exp(x)) FROM f GROUP BY id""").fetchall()
    assert len(want) == len(rows)
    for i, k, p in want:
        assert got[i].lang_id == model.languages[k] and got[i].lang_posterior == pytest.approx(p, abs=1e-9)


def invented(n_languages, n_rows):
    """Rows of languages with letters and words of their own; some rows declare nothing."""
    import random

    rows = []
    for k in range(n_languages):
        rng = random.Random(k)
        letters = [chr(0x4E00 + k * 40 + j) for j in range(40)]
        words = ["".join(rng.choices(letters, k=rng.randrange(2, 6))) for _ in range(30)]
        rows += [(k * n_rows + i, " ".join(rng.choices(words, k=40)), f"x{k:03}" if i % 10 else None, f"s{k % 7}", f"x{k:03}") for i in range(n_rows)]
    return rows


@pytest.mark.parametrize("languages", [80, 300])
def test_every_language_comes_back(spark, languages):
    rows = invented(languages, 20)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language.identify_documents(docs).collect()}
    assert len(got) == len(rows)
    assert [(r[0], got[r[0]].lang_id) for r in rows if got[r[0]].lang_id != r[4] or not got[r[0]].lang_keep] == []


def test_the_model_stays_of_one_size():
    assert [language.bits_for(n) for n in (1, 64, 65, 128, 129, 1 << 12)] == [16, 16, 15, 15, 14, 10]
    assert all(n << language.bits_for(n) <= language.MODEL_CELLS for n in range(1, (1 << 12) + 1))


@pytest.mark.parametrize("unit", ["<", "<script", "<!--", "<html ", "<style x", "</script ", "< ", "<html lang", "<script></script"])
def test_long_broken_markup_takes_time_in_proportion(spark, unit):
    """1 MB takes at most 2.3 times as long as 0.5 MB (the best of three, a tenth of a second aside)."""
    import time

    took = []
    for size in (1 << 19, 1 << 20):
        page = spark.createDataFrame([("a" + unit * (size // len(unit)),)], "html string").cache()
        page.count()
        out = page.select(F.length(language.visible_text(F.col("html"))), language.markup_language(F.col("html")))
        best = []
        for _ in range(3):
            at = time.perf_counter()
            out.collect()
            best.append(time.perf_counter() - at)
        took.append(min(best))
    assert took[1] < 2.3 * took[0] + 0.1


def test_visible_text(spark):
    cases = {
        "a<b>c</b>d": "a c d",
        "x<script>var t='</p>';</script>y<STYLE a=1>p{}</style >z": "x y z",
        "x<!-- a > b -->y<!-- open <b>z": "x y ",
        "x<script>never closed": "x ",
        "x<b never closed": "x ",
        "1 < 2 <b>3": "1  3",
        "": "",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "html string, want string")
    assert [(r.html, r.got) for r in df.withColumn("got", language.visible_text(F.col("html"))).collect() if r.got != r.want] == []
    heads = {'<html lang="fr">': "fr", "<HTML class=x LANG='De-AT'>": "de", "<html><body lang=en>": None, "<html ": None, "": None}
    df = spark.createDataFrame([(k, v) for k, v in heads.items()], "html string, want string")
    assert [(r.html, r.got) for r in df.withColumn("got", language.markup_language(F.col("html"))).collect() if r.got != r.want] == []


def test_long_texts_are_scored_as_short_ones(spark, monkeypatch):
    rows = [(i, ["the cat and the dog ", "le chat et le chien "][i % 2] * (1 if i < 40 else 40_000), ["en", "fr"][i % 2]) for i in range(44)]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    model = language.TextModel.fit(df.where("id < 40"), "text", "lang")
    texts = [r[1].encode() for r in rows]
    got = model.score(texts, [0] * len(texts))
    monkeypatch.setattr(language, "_FEW", 1 << 60)
    want = model.score(texts, [0] * len(texts))
    assert all(g == pytest.approx(w, rel=1e-9) for g, w in zip(got, want, strict=True))
