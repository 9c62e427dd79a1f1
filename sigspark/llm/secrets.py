"""Secret scans in DataFrame functions only.

Three fixed patterns give the base findings. Beside them, candidate strings
are read by a window that slides one character at a time; the Shannon entropy
of the window is kept up to date from the counts of the character that enters
and the one that leaves, and compared with a threshold for the candidate's
character class. Candidates on the allow list, or inside a base finding, are
suppressed; base findings never are.

Offsets come from running sums and suppression from running maxima, so that a
text of n characters with any number of findings takes about n log n steps.

Cases: a null or empty text has no findings; a very long text is one row of
one task; offsets are code points, end exclusive; rows are kept one by one, ties and repeats included; an empty table
gives no rows; extra columns are kept, those named like the results are
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import cut, let, running, running_sum
from .common import table


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


#: Key words of assignments, prefix of access keys, least lengths.
KEY_WORDS = ("password", "passwd", "secret", "token")
ASSIGN = "(" + "|".join([*map(_any_case, KEY_WORDS), _any_case("api") + "_?" + _any_case("key")]) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # all of a run, or too short: the same as filtering AKIA[A-Z0-9]+
HEX = "[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least entropy in bits a window of 20 needs, by character class.
THRESHOLDS = {"hex": 3.0, "alnum": 3.7, "base64": 3.9}
#: c * log2(c) for counts c as whole numbers, so that sums kept up to date are exact, and the most that a window's sum may be:
#: its entropy is log2(WINDOW) less the sum over WINDOW. No window has an entropy within 1e-4 of a threshold.
_UNIT = 1 << 40
TERMS = [round(c * math.log2(c) * _UNIT) if c else 0 for c in range(WINDOW + 2)]
MOST = {kind: math.floor((math.log2(WINDOW) - least) * WINDOW * _UNIT) for kind, least in THRESHOLDS.items()}
#: Allow list: strings with one of these are not secrets.
ALLOWED = r"(?i)(example|sample|placeholder|changeme|dummy|x{8}|0{8}|12345678|abcdefgh|^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^[0-9+/_=-]+$|^https?)"


def _matches(text: Column, pattern: str, least_group2: int = 0) -> Column:
    """array<struct<start int, end int, found string>> of the leftmost non-overlapping matches.

    The strings between matches and the matches themselves give the offsets.
    """

    def spans(found: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        columns = [found.alias("m"), running_sum(F.transform(F.arrays_zip(found.alias("m"), between.alias("g")), lambda p: F.length(p["g"]) + F.length(p["m"]))).alias("end")]
        if least_group2:
            columns.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("v"))
        parts = F.arrays_zip(*columns)
        if least_group2:
            parts = F.filter(parts, lambda p: F.length(p["v"]) >= least_group2)
        return F.transform(parts, lambda p: F.struct((p["end"] - F.length(p["m"])).alias("start"), p["end"].alias("end"), p["m"].alias("found")))

    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(empty)


def _window_span(s: Column) -> Column:
    """struct<a, b>: first start and last end (1-based, inclusive) of the windows of s over its class's threshold; a = 0: none."""
    table_ = F.array(*map(F.lit, TERMS))
    cls = F.when(s.rlike("^[0-9a-fA-F]+$"), MOST["hex"]).when(s.rlike("^[A-Za-z0-9]+$"), MOST["alnum"]).otherwise(MOST["base64"])
    chars = F.slice(F.split(s, "", -1), F.lit(1), F.length(s))

    def run(env: Column) -> Column:
        def step(st: Column, i: Column) -> Column:
            into = F.element_at(env["idx"], i)
            out = F.when(i > WINDOW, F.element_at(env["idx"], F.greatest(i - WINDOW, F.lit(1)))).otherwise(F.lit(0))
            n_in = F.element_at(st["n"], into)
            n_out = F.element_at(st["n"], F.greatest(out, F.lit(1)))
            gain = F.element_at(table_, n_in + 2) - F.element_at(table_, n_in + 1)
            loss = F.when(out > 0, F.element_at(table_, n_out + 1) - F.element_at(table_, F.greatest(n_out, F.lit(1)))).otherwise(F.lit(0).cast("long"))
            moved = F.when(
                into == out, F.struct(st["n"].alias("n"), st["s"].alias("s"))
            ).otherwise(
                F.struct(
                    F.transform(st["n"], lambda v, j: v + F.when(j + 1 == into, 1).otherwise(0) - F.when(j + 1 == out, 1).otherwise(0)).alias("n"),
                    (st["s"] + gain - loss).alias("s"),
                )
            )

            def close(z: Column) -> Column:
                hit = (i >= WINDOW) & (z["s"] <= env["most"])
                return F.struct(
                    z["n"].alias("n"),
                    z["s"].alias("s"),
                    F.when(hit & (st["a"] == 0), i - WINDOW + 1).otherwise(st["a"]).alias("a"),
                    F.when(hit, i).otherwise(st["b"]).alias("b"),
                )

            return let(moved, close)

        start = F.struct(F.array_repeat(F.lit(0), env["k"]).alias("n"), F.lit(0).cast("long").alias("s"), F.lit(0).alias("a"), F.lit(0).alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.size(env["idx"])), start, step, lambda st: F.struct(st["a"].alias("a"), st["b"].alias("b")))

    def indexed(e: Column) -> Column:
        idx = F.transform(e["chars"], lambda c: F.array_position(e["alpha"], c).cast("int"))
        return F.struct(idx.alias("idx"), F.size(e["alpha"]).alias("k"), e["most"].alias("most"))

    first = F.struct(chars.alias("chars"), F.array_distinct(chars).alias("alpha"), cls.alias("most"))
    return let(let(first, indexed), run)


def _not_inside(found: Column, spans: Column) -> Column:
    """The found that lie in none of the spans: those that end beyond all spans that start no later."""
    marked = lambda of, kind, text: F.transform(of, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), text(x).alias("found")))

    def open_(both: Column) -> Column:
        reach = running(F.transform(both, lambda x: F.when(x["kind"] == 0, x["end"]).otherwise(-1)), F.greatest)
        left = F.filter(F.arrays_zip(both.alias("x"), reach.alias("reach")), lambda z: (z["x"]["kind"] == 1) & (z["reach"] < z["x"]["end"]))
        return F.transform(left, lambda z: F.struct(z["x"]["start"].alias("start"), z["x"]["end"].alias("end"), z["x"]["found"].alias("found")))

    return let(F.array_sort(F.concat(marked(spans, 0, lambda x: F.lit("")), marked(found, 1, lambda x: x["found"]))), open_)


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """df with ``base_spans`` and ``secret_spans`` (base and entropy): array<struct<start, rank, end, kind>>, sorted."""
    body = F.coalesce(F.col(text), F.lit(""))

    def tagged(found: Column, rank: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(KINDS[rank]).alias("kind")))

    out = df.withColumn("base_spans", F.array_sort(F.concat(tagged(_matches(body, ASSIGN, ASSIGN_LEAST), 0), tagged(_matches(body, ACCESS), 1), tagged(_matches(body, HEX), 2))))
    wanted = F.filter(_matches(body, CANDIDATE), lambda m: m["found"].rlike("[0-9]") & m["found"].rlike("[A-Za-z]") & ~m["found"].rlike(ALLOWED))
    wanted = F.when(F.size(wanted) > 0, _not_inside(wanted, F.col("base_spans"))).otherwise(wanted)
    spans = F.transform(wanted, lambda m: F.struct(m["start"].alias("start"), _window_span(m["found"]).alias("w")))
    spans = F.transform(
        F.filter(spans, lambda x: x["w"]["a"] > 0),
        lambda x: F.struct((x["start"] + x["w"]["a"] - 1).alias("start"), F.lit(3).alias("rank"), (x["start"] + x["w"]["b"]).alias("end"), F.lit(KINDS[3]).alias("kind")),
    )
    return out.withColumn("secret_spans", F.array_sort(F.concat(F.col("base_spans"), spans)))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """text with each maximal covered stretch of spans replaced by mask."""

    def masked(ends: Column) -> Column:
        kept = F.transform(spans, lambda s, i: F.struct(F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("start"), s["start"].alias("end")))
        kept = F.filter(kept, lambda k: k["start"] <= k["end"])
        rest = F.struct(F.get(ends, F.size(ends) - 1).alias("start"), F.length(text).alias("end"))
        return F.array_join(cut(text, F.concat(kept, F.array(rest))), mask)

    return F.when(F.size(spans) > 0, let(running(F.transform(spans, lambda s: s["end"]), F.greatest), masked)).otherwise(text)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql_found(name: str, rank: int, kind: str, pattern: str, value: int = 0) -> str:
    q = pattern.replace("'", "''")
    return f"""{name} AS (
  SELECT r, {rank} AS rank, '{kind}' AS kind, f[i] AS m, v[i] AS v,
    CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT r, regexp_extract_all(t, '{q}') AS f, regexp_extract_all(t, '{q}', {value}) AS v, regexp_split_to_array(t, '{q}') AS g FROM d WHERE regexp_matches(t, '{q}')) x, unnest(range(1, len(f) + 1)) u(i)
)"""


OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
{_sql_found("s0", 0, "assign", ASSIGN, 2)}, {_sql_found("s1", 1, "access", ACCESS)}, {_sql_found("s2", 2, "hex", HEX)}, {_sql_found("s3", 3, "entropy", CANDIDATE)},
base AS (
  SELECT r, rank, kind, a, a + length(m) AS b FROM s0 WHERE length(v) >= {ASSIGN_LEAST}
  UNION ALL SELECT r, rank, kind, a, a + length(m) FROM s1 UNION ALL SELECT r, rank, kind, a, a + length(m) FROM s2
), wanted AS (
  SELECT row_number() OVER () AS c, r, a, m, CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN {THRESHOLDS["hex"]} WHEN regexp_full_match(m, '[A-Za-z0-9]+') THEN {THRESHOLDS["alnum"]} ELSE {THRESHOLDS["base64"]} END AS least
  FROM s3 WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT regexp_matches(m, '{ALLOWED}')
    AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = s3.r AND base.a <= s3.a AND base.b >= s3.a + length(s3.m))
), windows AS (
  SELECT c, i, substr(m, CAST(j AS INTEGER), 1) AS ch, count(*) AS n FROM wanted, unnest(range(1, length(m) - {WINDOW - 2})) w(i), unnest(range(i, i + {WINDOW})) p(j) GROUP BY c, i, ch
), high AS (
  SELECT c, min(i) AS first, max(i) AS last FROM (SELECT c, i, log2({WINDOW}) - sum(n * log2(n)) / {WINDOW} AS h FROM windows GROUP BY c, i) e JOIN wanted USING (c) WHERE h >= least - 1e-9 GROUP BY c
), spans AS (
  SELECT * FROM base UNION ALL SELECT r, 3, 'entropy', a + first - 1, a + last - 1 + {WINDOW} FROM high JOIN wanted USING (c)
), sums AS (
  SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b) FILTER (rank < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank, b) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums USING (r)
"""


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"),
        _listed(F.col("secret_spans")).alias("spans"),
    )
