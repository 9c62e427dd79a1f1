"""Parameter blocks: a 512-byte system block and any number of 512-byte DSP blocks, little-endian."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK = 512
#: Name, kind and count of each field of the system block, in file order.
SYSTEM_FIELDS = [
    ("fs", "I", 1), ("AUX_mode", "I", 1), ("Nch", "I", 1), ("convCmd", "H", 64), ("dispCH", "I", 1), ("func1", "I", 1), ("func2", "I", 1), ("cmd_ch", "I", 1), ("rec_ch", "I", 1),
    ("stim_mode", "I", 1), ("cl_mode", "I", 1), ("stim_interval", "I", 4), ("pulse_width", "I", 4), ("pulse_cnt", "I", 4), ("stim_delay", "I", 4), ("stim_RndDelay", "I", 4),
    ("trigger_trainStart", "I", 1), ("trigger_trainDuration", "I", 1), ("trigger_gain", "f", 4), ("SD_capacity", "I", 1), ("LED_pulse_CNT", "I", 1), ("preview_channel_bank", "I", 1),
    ("system_status", "I", 1), ("stim_intensity", "I", 4), ("stim_ch", "I", 4), ("MISC_ratio", "B", 1), ("PREV_ratio", "B", 1), ("MISC_interval", "H", 1), ("error_code", "I", 1),
    ("firmware_version", "H", 1), ("hw_version", "H", 1), ("date", "I", 1), ("time", "I", 5), ("MAC", "B", 8), ("Vbatt_threshold", "H", 1), ("unassigned_16", "H", 1), ("unassigned", "I", 36),
]
#: The same for a DSP block; 12 bytes of padding follow.
DSP_FIELDS = [("chOrd", "B", 128), ("formula", "B", 1), ("func1", "B", 1), ("func2", "B", 1), ("MAOrd1", "B", 1), ("filter1", "f", 46), ("filter2", "f", 46)]
TYPES = {"I": "bigint", "H": "int", "B": "smallint", "f": "float"}
#: stim_interval is stored in tenths.
TENTHS = "stim_interval"


def _ddl(fields: list[tuple[str, str, int]]) -> str:
    kind = lambda name, c, n: (f"array<{'double' if name == TENTHS else TYPES[c]}>" if n > 1 else TYPES[c])
    return ", ".join(f"`{name}`: {kind(name, c, n)}" for name, c, n in fields)


SCHEMA = f"path string, sys struct<{_ddl(SYSTEM_FIELDS)}>, dsp array<struct<{_ddl(DSP_FIELDS)}>>"


def _unpack(data: bytes, fields: list[tuple[str, str, int]]) -> dict[str, object]:
    values = iter(struct.unpack_from("<" + "".join(f"{n}{c}" for _, c, n in fields), data))
    out = {}
    for name, _, n in fields:
        got = [next(values) for _ in range(n)]
        out[name] = [v / 10 for v in got] if name == TENTHS else got if n > 1 else got[0]
    return out


def pack(values: dict[str, object], fields: list[tuple[str, str, int]]) -> bytes:
    """A block of 512 bytes; missing fields are 0, stim_interval is given in units."""
    flat: list = []
    for name, _, n in fields:
        v = values.get(name, [0] * n if n > 1 else 0)
        v = list(v) if n > 1 else [v]
        flat += [round(x * 10) for x in v] if name == TENTHS else v
    return struct.pack("<" + "".join(f"{n}{c}" for _, c, n in fields), *flat).ljust(BLOCK, b"\0")


def parse(content: bytes) -> tuple[dict, list[dict]]:
    if len(content) < BLOCK:
        raise ValueError("a parameter file has at least 512 bytes")
    return _unpack(content, SYSTEM_FIELDS), [_unpack(content[at : at + BLOCK], DSP_FIELDS) for at in range(BLOCK, len(content) // BLOCK * BLOCK, BLOCK)]


def read_header(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: path, sys, dsp. A missing file is an error."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for p, c in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                sys_, dsp = parse(c)
                kind = pa.schema([pa.field("path", pa.string()), pa.field("sys", sys_type), pa.field("dsp", pa.list_(dsp_type))])
                yield pa.RecordBatch.from_pylist([{"path": p, "sys": sys_, "dsp": dsp}], schema=kind)

    arrow = {"I": pa.int64(), "H": pa.int32(), "B": pa.int16(), "f": pa.float32()}
    of = lambda fields: pa.struct([(n, pa.list_(pa.float64() if n == TENTHS else arrow[c]) if k > 1 else arrow[c]) for n, c, k in fields])
    sys_type, dsp_type = of(SYSTEM_FIELDS), of(DSP_FIELDS)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, SCHEMA)


def recording_mode(fs: int, nch: int) -> dict[str, object]:
    """Rates and channels that follow from a header: without a rate, analog channels 5 and 6 stand in for the electrodes.

    Only a recording of 64 electrodes has 16 analog channels; without a rate there are two, whatever the header says.
    """
    nch = nch if fs else 2
    return {"fs": fs or 1250, "nch": nch, "analog_channels": 16 if nch == 64 else 8, "from_analog": not fs}
