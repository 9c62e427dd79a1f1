"""Column functions of the signal algebra: conversions, scaling, bits, labels, image arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Full scales of the inertial sensors.
ACC_SCALE = 8 * 9.8 / 32768
GYR_SCALE = 2000 / 180 * math.pi / 32768
MAG_SCALE = (1150 / 32768, 1150 / 32768, 2500 / 32768)
ACC3_SCALE = 2 / 65535
GRAVITY = 9.81
INT16 = (-32768, 32767)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: Column | str, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(c)))


def saturate_int16(c: Column | str) -> Column:
    """Round half away from zero, saturate, store as 16 bits."""
    return clip(F.round(col(c)), *INT16).cast("short")


def truncate_to(c: Column | str, low: int, high: int, kind: str) -> Column:
    """Clip, then drop the fraction."""
    return clip(c, low, high).cast(kind)


def unsigned16(c: Column | str) -> Column:
    """The same 16 bits read as unsigned."""
    return col(c).cast("int").bitwiseAND(F.lit(65535))


def signed16(c: Column | str) -> Column:
    """The same 16 bits read as signed."""
    u = unsigned16(c)
    return F.when(u >= 32768, u - 65536).otherwise(u)


def audio_sample(c: Column | str, compat: bool = False) -> Column:
    """Offset-binary sample as a signed one; compat keeps the unsigned wrap-around."""
    u = unsigned16(c)
    return (u + 32768) % 65536 if compat else u - 32768


def bit(c: Column | str, i: int | Column) -> Column:
    return F.call_function("shiftright", col(c), F.lit(i) if isinstance(i, int) else i).bitwiseAND(F.lit(1))


def bit_list(c: Column | str, n: int) -> Column:
    """array<int> of the n lowest bits, least significant first."""
    word = col(c).cast("long").bitwiseAND(F.lit((1 << n) - 1))
    return F.array(*(bit(word, i).cast("int") for i in range(n)))


def norm(*axes: Column | str) -> Column:
    return F.sqrt(sum((col(a) * col(a) for a in axes[1:]), col(axes[0]) * col(axes[0])))


def channels(array: Column | str, selection: list[int]) -> Column:
    """Channels by 1-based number; order and duplicates are kept."""
    return F.array(*(F.element_at(col(array), i) for i in selection))


def imu_scaled(array: Column | str) -> Column:
    """struct of nine axes in m/s2, rad/s and uT from raw acc, gyr and mag."""
    scales = [ACC_SCALE] * 3 + [GYR_SCALE] * 3 + list(MAG_SCALE)
    names = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]
    return F.struct(*((F.element_at(col(array), i + 1) * F.lit(s)).alias(n) for i, (s, n) in enumerate(zip(scales, names, strict=True))))


def imu3_scaled(array: Column | str) -> Column:
    return F.struct(*((F.element_at(col(array), i + 1) * F.lit(ACC3_SCALE)).alias(f"acc_{a}") for i, a in enumerate("xyz")))


def seconds_of(index: Column | str, fs: float) -> Column:
    """0-based sample clock."""
    return col(index) / F.lit(float(fs))


def frame_count(n_bytes: Column | str, frame_bytes: int) -> Column:
    return F.floor(col(n_bytes) / frame_bytes).cast("long")


def row_of(linear: Column | str, width: int = 320) -> Column:
    """Row of a 1-based linear pixel number."""
    return F.floor((col(linear) - 1) / width).cast("int")


def column_of(linear: Column | str, width: int = 320) -> Column:
    return F.pmod(col(linear) - 1, F.lit(width)).cast("int")


def event_label(kind: Column | str, phase: Column | str, channel: Column | str) -> Column:
    return F.concat_ws(" ", col(kind), col(phase), col(channel).cast("string"))


def event_line(t_s: Column | str, text: Column | str) -> Column:
    """Milliseconds with six decimals, a tab, the text."""
    return F.format_string("%.6f\t%s", col(t_s) * 1000.0, col(text))


def event_time(line: Column | str) -> Column:
    """Seconds: the first token, in milliseconds. A token that is no number gives null; text is never evaluated."""
    return F.regexp_extract(col(line), r"^[ \t]*([^ \t]*)", 1).try_cast("double") / 1000.0


def event_text(line: Column | str) -> Column:
    return F.regexp_replace(col(line), r"^[ \t]*[^ \t]*[ \t]*", "")


def sibling(path: Column | str, old: str, new: str) -> Column:
    return F.replace(col(path), F.lit(old), F.lit(new))


def file_number(prefix: str, n: Column | str) -> Column:
    """device_event.dNN.evt and the like."""
    return F.concat(F.lit(prefix), F.lpad(col(n).cast("string"), 2, "0"), F.lit(".evt"))


def direct(a: Column | str) -> Column:
    return col(a)


def differential(a: Column | str, b: Column | str) -> Column:
    return col(a) - col(b)


def current_source_density(a: Column | str, b: Column | str, c: Column | str) -> Column:
    return 2 * col(a) - col(b) - col(c)


def unpack_first(b0: Column | str, b1: Column | str) -> Column:
    """First 10-bit pixel of three bytes."""
    return F.call_function("shiftleft", col(b0).bitwiseAND(F.lit(0x7F)), F.lit(3)).bitwiseOR(F.call_function("shiftright", col(b1).bitwiseAND(F.lit(0xE0)), F.lit(5)))


def unpack_second(b1: Column | str, b2: Column | str) -> Column:
    """Second 10-bit pixel of three bytes."""
    return F.call_function("shiftleft", col(b1).bitwiseAND(F.lit(0x07)), F.lit(7)).bitwiseOR(F.call_function("shiftright", col(b2).bitwiseAND(F.lit(0xFE)), F.lit(1)))


def rotate180(pixels: Column | str) -> Column:
    return F.reverse(col(pixels))


def array_mean(values: Column | str) -> Column:
    v = col(values)
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(v).cast("double"), F.lit(0.0))


def brightened(pixels: Column | str, target: float = 160.0) -> Column:
    """Scaled to the target mean, clipped to 0..255, fraction dropped; a black frame is left as it is."""
    p = col(pixels)
    gain = F.coalesce(F.lit(target) / F.nullif(array_mean(p), F.lit(0.0)), F.lit(1.0))
    return F.transform(p, lambda x: clip(x * gain, 0, 255).cast("int"))


def quaternion_matrix(w: Column, x: Column, y: Column, z: Column) -> Column:
    """array<double>(9), row by row, of a unit quaternion."""
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y),
        2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x),
        2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y),
    )


def rotated(matrix: Column | str, x: Column, y: Column, z: Column) -> Column:
    """struct<x, y, z>: matrix times vector."""
    m = col(matrix)
    row = lambda k: F.get(m, F.lit(3 * k)) * x + F.get(m, F.lit(3 * k + 1)) * y + F.get(m, F.lit(3 * k + 2)) * z
    return F.struct(row(0).alias("x"), row(1).alias("y"), row(2).alias("z"))


def ten_to_eight(c: Column | str) -> Column:
    """A 10-bit value on the scale of 8 bits, its fraction kept."""
    return col(c) / 4.0


def utf16_string(text: Column | str) -> Column:
    """struct<length, bytes>: UTF-16 little-endian with its byte length; an empty string has length 0."""
    data = F.encode(col(text), "UTF-16LE")
    return F.struct(F.octet_length(data).cast("long").alias("length"), data.alias("bytes"))


def xml_text(xml: Column | str, tag: str) -> Column:
    """Text of the first such element without others inside, any case; empty where there is none."""
    return F.regexp_extract(col(xml), rf"(?i)<{tag}>([^<]*)</{tag}>", 1)


def xml_count(xml: Column | str, tag: str) -> Column:
    """Number of opening tags without attributes, any case."""
    return F.size(F.regexp_extract_all(col(xml), F.lit(rf"(?i)<{tag}>"), F.lit(0))).cast("long")


def xml_number(xml: Column | str, tag: str) -> Column:
    """First number in a tag, any case."""
    return F.regexp_extract(col(xml), rf"(?i)<{tag}>\s*(-?[0-9]+)\s*</{tag}>", 1).try_cast("int")


def xml_channels(xml: Column | str, ordered: bool) -> Column:
    """1-based numbers of the channels that are not skipped, sorted or in file order."""
    found = F.transform(F.regexp_extract_all(col(xml), F.lit(r'(?i)<channel skip="0">\s*([0-9]+)\s*</channel>'), F.lit(1)), lambda c: c.cast("int") + 1)
    return F.array_sort(found) if ordered else found
