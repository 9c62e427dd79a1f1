"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<s>ROLE[INST] TEXT [/INST]</s>``. A conversation is
first rendered raw, reparsed by the deterministic parser below and compared
with its source; where the recovered turns differ, it is rendered again with
its texts and roles escaped and marked by a leading ``~``. Escaped content has
no ``<`` or ``[``, so the second rendering always parses back.

Escapes (fixed values): ``~`` -> ``~t``, ``<`` -> ``~l``, ``[`` -> ``~b``.

Cases: null text or role is the empty string; turns are ordered by turn (null
first), ties by role then text, and repeated rows are kept; rows with
a null conv_id are one conversation; a conversation is one row and must fit a
task, offsets in it come from running sums, however long it is; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import cut, running_sum
from .common import table

LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("~"), F.lit("~t")), F.lit("<"), F.lit("~l")), F.lit("["), F.lit("~b"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("~l"), F.lit("<")), F.lit("~b"), F.lit("[")), F.lit("~t"), F.lit("~"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<s>"), t["role"], F.lit("[INST] "), t["text"], F.lit(" [/INST]</s>"))), "")


def _pieces(body: Column) -> Column:
    """The parser: cut after each ``</s>``, then at the first ``[INST] `` of a piece; null where a piece is no turn."""

    def piece(p: Column) -> Column:
        head = F.length(F.substring_index(p, "[INST] ", 1))
        role = F.substr(p, F.lit(4), head - 3)
        text = F.substr(p, head + 8, F.length(p) - head - 15)
        good = p.startswith("<s>") & p.contains("[INST] ") & p.endswith(" [/INST]")
        return F.when(good, F.struct(role.alias("role"), text.alias("text")))

    cut = F.split(body, "</s>", -1)
    return F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), piece)


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, unescaped."""
    escaped = formatted.startswith("~")
    body = F.when(escaped, F.substr(formatted, F.lit(2))).otherwise(formatted)
    undo = lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))
    pieces = _pieces(body)
    return F.when(escaped, F.transform(pieces, undo)).otherwise(pieces)


def format_chat(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, escaped, loss_runs): loss_runs is the loss mask over ``formatted`` as run lengths."""
    rows = conversations.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    turns = turns.withColumn("t", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    raw = turns.withColumn("raw", _render(F.col("t")))
    same = raw.withColumn("escaped", ~F.coalesce(parse_turns(F.col("raw")) == F.col("t"), F.lit(False)))
    safe = F.transform("t", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    out = same.withColumn("u", F.when(F.col("escaped"), safe).otherwise(F.col("t")))
    out = out.withColumn("safe", F.when(F.col("escaped"), F.concat(F.lit("~"), _render(F.col("u")))))
    broken = F.raise_error(F.concat(F.lit("the escaped form does not parse back, conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    out = out.withColumn("formatted", F.when(~F.col("escaped"), F.col("raw")).when(parse_turns(F.col("safe")) == F.col("t"), F.col("safe")).otherwise(broken))
    runs = F.transform(
        F.arrays_zip("t", "u"),
        lambda z: F.struct(
            (F.length(z["u"]["role"]) + 10).alias("before"),
            F.length(z["u"]["text"]).alias("text"),
            F.lit(12).alias("after"),
            (z["t"]["role"] == LOSS_ROLE).alias("in_loss"),
        ),
    )
    return out.select("conv_id", "formatted", "escaped", runs.alias("loss_runs"))


def loss_text(formatted: Column, runs: Column) -> Column:
    """What the loss mask covers of a formatted conversation, unescaped."""
    escaped = formatted.startswith("~")
    head = F.when(escaped, 1).otherwise(0)
    ends = running_sum(F.transform(runs, lambda r: r["before"] + r["text"] + r["after"]))
    covered = F.filter(F.arrays_zip(runs.alias("r"), ends.alias("end")), lambda z: z["r"]["in_loss"])
    stretches = F.transform(covered, lambda z: F.struct((head + z["end"] - z["r"]["after"] - z["r"]["text"]).alias("start"), (head + z["end"] - z["r"]["after"]).alias("end")))
    pieces = cut(formatted, stretches)
    return F.array_join(F.when(escaped, F.transform(pieces, unescape)).otherwise(pieces), "")


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text): turns recovered from ``formatted`` alone, loss_text cut from it by ``loss_runs``."""
    out = formatted.withColumn("turns", parse_turns(F.col("formatted")))
    return out.select("conv_id", "formatted", "turns", loss_text(F.col("formatted"), F.col("loss_runs")).alias("loss_text"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = "</s>[INST] ok [/INST]"
    base = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")), F.struct(F.lit(1).cast("long").alias("turn"), F.lit(LOSS_ROLE).alias("role")))).alias("x"))
    extra = extra.select("conv_id", "x.turn", "x.role", F.lit(sample).alias("text"))
    back = read_chat(format_chat(base.unionByName(extra)))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), k AS (
  SELECT conv_id, count(*) AS n_turns,
    bool_or(contains(text, '</s>') OR contains(role, '</s>') OR contains(role, '[INST] ')) AS esc,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(length(role) + length(text) + 22) AS plain,
    sum(length(role) + length(text) - length(replace(replace(replace(role || text, '~', ''), '<', ''), '[', ''))) AS marks
  FROM c GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(plain + CASE WHEN esc THEN marks + 1 ELSE 0 END AS BIGINT) AS formatted_chars
FROM k
"""
