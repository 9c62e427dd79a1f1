"""Vendor-style recording header: channel table and binary form."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.functions.columns import utf16_string  # noqa: F401  the column form of q_string

#: Magic number, kinds of channels, impedance-test rates, lower band edge.
MAGIC = 0xC6912702
AMPLIFIER, ADC = 0, 3
TEST_RATE = 1000.0
LOW_EDGE = 0.1


def q_string(text: str) -> bytes:
    """Byte length, then UTF-16; an empty string has length 0."""
    data = text.encode("utf-16-le")
    return struct.pack("<I", len(data)) + data


def channel_table(spark: SparkSession, nch: int) -> DataFrame:
    """(n, kind, name) of each channel: amplifier channels, then a quarter as many ADC channels; n is 1-based, names are 0-based."""
    kinds = F.array(F.struct(F.lit(AMPLIFIER).alias("kind"), F.lit(nch).alias("k")), F.struct(F.lit(ADC).alias("kind"), F.lit(nch // 4).alias("k")))
    each = spark.range(1).select(F.explode(kinds).alias("g")).select("g.*").where("k > 0")
    each = each.select("kind", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("n"))
    zero_based = (F.col("n") - 1).cast("string")
    name = F.when(F.col("kind") == AMPLIFIER, F.concat(F.lit("A-"), F.lpad(zero_based, 3, "0"))).otherwise(F.concat(F.lit("CH"), zero_based))
    return each.select("n", "kind", name.alias("name"))


def with_record(channels: DataFrame) -> DataFrame:
    """channels(n, kind, name) with ``record``: the bytes of each in the header, as ``_channel`` makes them."""
    word = lambda c: F.format_string("%02X%02X", F.pmod(c, F.lit(256)).cast("int"), F.floor(c / 256).cast("int"))
    name = utf16_string("name")
    text = F.concat(word(name["length"]), F.lit("0000"), F.hex(name["bytes"]))
    n, kind, one, zero = F.col("n"), F.col("kind"), F.lit(1), F.lit(0)
    fields = [word(c) for c in (n, n, kind, one, n, one, *[zero] * 8)]  # the last two pairs are empty 32-bit floats
    return channels.withColumn("record", F.unhex(F.concat(text, text, *fields)))


def _channel(n: int, kind: int, name: str) -> bytes:
    return q_string(name) * 2 + struct.pack("<10h2f", n, n, kind, 1, n, 1, 0, 0, 0, 0, 0.0, 0.0)


def header_bytes(fs: float, nch: int, cl_mode: int = 0) -> bytes:
    """The whole header: rates, notch, three empty notes, a group of amplifier channels and one of ADC channels."""
    band = (fs / 2, LOW_EDGE, fs / 2)
    out = [struct.pack("<I2h", MAGIC, 0, 0), struct.pack("<fh6f", fs, cl_mode, *band, *band), struct.pack("<h2f", 0, TEST_RATE, TEST_RATE), q_string("") * 3, struct.pack("<h", 2)]
    for title, prefix, kind, n in (("Port A", "A", AMPLIFIER, nch), ("ADC", "ADC", ADC, nch // 4)):
        out.append(q_string(title) + q_string(prefix) + struct.pack("<3h", 1, n, n))
        out += [_channel(i, kind, f"A-{i - 1:03d}" if kind == AMPLIFIER else f"CH{i - 1}") for i in range(1, n + 1)]
    return b"".join(out)


def write_header(path: str, **fields: object) -> None:
    with open(path, "wb") as f:
        f.write(header_bytes(**fields))
