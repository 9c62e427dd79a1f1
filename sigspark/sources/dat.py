"""Interleaved binary signals: a Python data source and sink ("sigdat").

Options: path (a file, a folder or a glob, as a mounted path or a URI), file (name or pattern of the files
of a folder, default *.dat; one file a session), nch, dtype (default int16),
select (1-based channels, order and duplicates kept), start and until (0-based,
the end included; a negative start counts from the end), skip_bytes (bytes
skipped after each value), frames_per_partition, layout (wide or long).

A file is cut into partitions by arithmetic on its size; a trailing partial
frame is dropped. Filters on ``sample_idx`` are pushed into the byte ranges
when ``spark.sql.python.filterPushdown.enabled`` is set.

Written is by position: a task puts each sample where its index says, so that
no byte passes through the driver and a task that runs twice writes the same.
"""

from __future__ import annotations

import errno
import os
import posixpath
import shutil
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from . import files

#: Names of sample formats.
FORMATS = {"int8": "<i1", "uint8": "<u1", "schar": "<i1", "uchar": "<u1", "int16": "<i2", "uint16": "<u2", "int32": "<i4", "uint32": "<u4", "int64": "<i8", "uint64": "<u8", "single": "<f4", "float32": "<f4", "double": "<f8", "float64": "<f8"}
SPARK_TYPES = {"i1": "byte", "u1": "short", "i2": "short", "u2": "int", "i4": "int", "u4": "long", "i8": "long", "u8": "decimal(20,0)", "f4": "float", "f8": "double"}
ARROW_TYPES = {"byte": pa.int8(), "short": pa.int16(), "int": pa.int32(), "long": pa.int64(), "decimal(20,0)": pa.decimal128(20, 0), "float": pa.float32(), "double": pa.float64()}
BATCH = 16_384


def format_of(name: str) -> np.dtype:
    if name not in FORMATS:
        raise ValueError(f"unknown sample format {name!r}")
    return np.dtype(FORMATS[name])


def session_of(path: str) -> str:
    """The name of the folder that a file lies in."""
    return posixpath.basename(posixpath.dirname(path))


@dataclass
class Frames:
    """Frames first..last of a file."""

    path: str
    session: str
    first: int
    last: int


@dataclass
class Ranges(InputPartition):
    """What a task reads: a part of a long file, or many short ones."""

    parts: list[Frames]


#: Opening a file counts as this part of a partition's frames: far less than what starting a task takes.
OPENING = 1 / 256


def packed(parts: list[Frames], frames: int) -> list[Ranges]:
    """Ranges in their order, as many together as make a partition."""
    out, held = [], float(frames)
    for part in parts:
        cost = part.last - part.first + 1 + frames * OPENING
        if held + cost > frames:
            out.append(Ranges([]))
            held = 0.0
        out[-1].parts.append(part)
        held += cost
    return out or [Ranges([])]


class DatReader(DataSourceReader):
    def __init__(self, options: dict):
        self.nch = int(options.get("nch", 1))
        self.dtype = format_of(options.get("dtype", "int16"))
        self.skip = int(options.get("skip_bytes", 0))
        self.select = [int(c) for c in options["select"].split(",")] if options.get("select") else list(range(1, self.nch + 1))
        if any(not 1 <= c <= self.nch for c in self.select):
            raise ValueError(f"channels {self.select} are not all within 1..{self.nch}")
        self.start, self.until = float(options.get("start", 0)), float(options.get("until", "inf"))
        self.per_partition = int(options.get("frames_per_partition", 1 << 20))
        self.layout = options.get("layout", "wide")
        self.files = files.listed(options["path"], options.get("file", "*.dat"))
        owner: dict[str, str] = {}
        for f, _ in self.files:
            if owner.setdefault(session_of(f), f) != f:
                raise ValueError(f"{owner[session_of(f)]} and {f} are of one session; choose one with the option file")
        self.frame_bytes = self.nch * (self.dtype.itemsize + self.skip)
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) == ("sample_idx",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        from sigspark.operators.signals import resolve_range

        out = []
        for path, size in self.files:
            n = size // self.frame_bytes
            first, last = resolve_range(n, self.start, self.until)
            first, last = max(first, self.low), min(last, self.high)
            out += [Frames(path, session_of(path), at, min(at + self.per_partition - 1, last)) for at in range(first, last + 1, self.per_partition)]
        return packed(out, self.per_partition)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        # the rows of short files go on together
        held: list[pa.RecordBatch] = []
        rows = 0
        for part in partition.parts:
            for batch in self._read(part):
                held.append(batch)
                rows += batch.num_rows
                if rows >= BATCH:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    def _read(self, partition: Frames) -> Iterator[pa.RecordBatch]:
        kind = ARROW_TYPES[SPARK_TYPES[self.dtype.str[1:]]]
        with files.opened(partition.path) as f:
            for at in range(partition.first, partition.last + 1, BATCH):
                n = min(BATCH, partition.last - at + 1)
                f.seek(at * self.frame_bytes)
                raw = f.read(n * self.frame_bytes)
                if self.skip:
                    spaced = np.frombuffer(raw, np.uint8).reshape(n, self.nch, self.dtype.itemsize + self.skip)
                    x = np.ascontiguousarray(spaced[:, :, : self.dtype.itemsize]).view(self.dtype)[:, :, 0]
                else:
                    x = np.frombuffer(raw, self.dtype).reshape(n, self.nch)
                if self.select != list(range(1, self.nch + 1)):
                    x = x[:, [c - 1 for c in self.select]]
                index = np.arange(at, at + n)
                value = pa.array([Decimal(v) for v in x.reshape(-1).tolist()], kind) if self.dtype.str[1:] == "u8" else pa.array(x.reshape(-1)).cast(kind)
                if self.layout == "long":
                    rows = [pa.repeat(pa.scalar(partition.session), x.size), pa.array(np.repeat(index, x.shape[1])), pa.array(np.tile(np.array(self.select, np.int32), n)), value]
                    yield pa.RecordBatch.from_arrays(rows, names=["session", "sample_idx", "channel", "value"])
                else:
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), value)
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(partition.session), n), pa.array(index), lists], names=["session", "sample_idx", "x"])


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: (session, frames, least index, greatest index, bytes of a frame)."""

    sessions: list


def wav_header(frames: int, rate: int) -> bytes:
    """What stands before the samples of a mono 16-bit PCM file."""
    return struct.pack("<4sI4s4sI2H2I2H4sI", b"RIFF", 36 + 2 * frames, b"WAVE", b"fmt ", 16, 1, 1, rate, 2 * rate, 2, 16, b"data", 2 * frames)


WAV_HEADER = len(wav_header(0, 1))


def _copied(old: str, fd: int, size: int) -> None:
    """The first bytes of a file into another, by the kernel where it can."""
    with open(old, "rb") as f:
        at = 0
        while at < size:
            try:
                n = os.copy_file_range(f.fileno(), fd, min(size - at, 1 << 30), at, at)
            except OSError as e:
                if e.errno not in (errno.EXDEV, errno.ENOSYS, errno.EINVAL, errno.EOPNOTSUPP):
                    raise
                n = os.pwrite(fd, os.pread(f.fileno(), min(size - at, 1 << 20), at), at)
            if not n:
                raise OSError(f"{old} has become shorter")
            at += n


class _Positions:
    """Frames of rows put into files by their index."""

    def __init__(self, options: dict):
        system, self.path, _ = files.place(options["path"])
        if not isinstance(system, fs.LocalFileSystem):
            raise ValueError(f"{options['path']} is not mounted: samples cannot be put into it by position")
        self.dtype = options.get("dtype", "int16")
        self.first, self.file, self.head, self.old = int(options.get("first", 0)), options.get("file"), 0, 0
        format_of(self.dtype)

    def _frames(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(index, a row of bytes for each frame); values are rounded and saturated, a null is 0."""
        dtype = format_of(self.dtype)
        x = batch.column("x")
        if len(set(x.value_lengths().unique().to_pylist()) - {None}) != 1 or x.null_count:
            raise ValueError("all frames of a recording have the same channels")
        values = x.flatten().fill_null(0).to_numpy(zero_copy_only=False)
        if dtype.kind in "iu":
            info, values = np.iinfo(dtype), values.astype(float)
            values = np.clip(np.sign(values) * np.floor(np.abs(values) + 0.5), info.min, info.max)
        return batch.column("sample_idx").to_numpy(), values.astype(dtype).reshape(batch.num_rows, -1).view(np.uint8)

    def put(self, batches: Iterator[pa.RecordBatch], root: str) -> Part:
        """Write rows below root, or into it where there is one file; runs of consecutive frames at once."""
        said: dict[str, list] = {}
        now, fd = None, -1
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                index, raw = self._frames(batch)
                if (index < self.first).any():
                    raise ValueError(f"there are samples before {self.first}")
                names = np.array(batch.column("session").to_pylist(), object) if self.file else np.full(len(index), "", object)
                cut = np.flatnonzero((np.diff(index) != 1) | (names[1:] != names[:-1])) + 1
                for i, j in zip([0, *cut], [*cut, len(index)], strict=True):
                    if names[i] != now or fd < 0:
                        if fd >= 0:
                            os.close(fd)
                        now, name = names[i], root if not self.file else f"{root}/{names[i]}/{self.file}"
                        if self.file:
                            if not names[i] or "/" in names[i] or names[i] in (".", ".."):
                                raise ValueError(f"{names[i]!r} is no name of a session")
                            os.makedirs(posixpath.dirname(name), exist_ok=True)
                        fd = os.open(name, os.O_WRONLY | os.O_CREAT, 0o644)
                    data, at = memoryview(np.ascontiguousarray(raw[i:j])).cast("B"), self.head + self.old + (int(index[i]) - self.first) * raw.shape[1]
                    while data:
                        n = os.pwrite(fd, data, at)
                        data, at = data[n:], at + n
                    held = said.setdefault(now, [0, int(index[i]), int(index[j - 1]), raw.shape[1]])
                    held[:3] = held[0] + int(j - i), min(held[1], int(index[i])), max(held[2], int(index[j - 1]))
                    if held[3] != raw.shape[1]:
                        raise ValueError("all frames of a recording have the same channels")
        finally:
            if fd >= 0:
                os.close(fd)
        return Part([(k, *v) for k, v in said.items()])


class DatWriter(_Positions, DataSourceArrowWriter):
    """A recording, or with the option ``file`` a folder with one for each ``session`` of the rows.

    Tasks write into a new place beside the path, which takes its name when all
    have ended: until then, and if the job fails, what was there before stays.
    ``first`` is the index of the first frame; a hole or a frame that comes twice
    is an error. Appended frames follow those of the old file, which one of the
    tasks copies. With ``wav_rate`` a WAV header stands in front.

    The path must be one that all executors have mounted.
    """

    def __init__(self, options: dict, overwrite: bool):
        super().__init__(options)
        self.append, self.wav_rate = not overwrite, int(options.get("wav_rate", 0))
        if self.append and (self.file or self.wav_rate):
            raise ValueError("only single recordings are appended to")
        self.head = WAV_HEADER if self.wav_rate else 0
        self.old = os.path.getsize(self.path) if self.append and os.path.exists(self.path) else 0
        self.new = f"{self.path}.{uuid.uuid4().hex}.new"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        if self.old and TaskContext.get().partitionId() == 0:
            fd = os.open(self.new, os.O_WRONLY | os.O_CREAT, 0o644)
            try:
                _copied(self.path, fd, self.old)
            finally:
                os.close(fd)
        return self.put(iterator, self.new)

    def commit(self, messages: list[Part]) -> None:
        all_: dict[str, list] = {}
        for k, n, low, high, size in (s for m in messages if m for s in m.sessions):
            held = all_.setdefault(k, [0, low, high, size])
            held[:3] = held[0] + n, min(held[1], low), max(held[2], high)
        for k, (n, low, high, _) in all_.items():
            if low != self.first or n != high - low + 1:
                self.abort(messages)
                raise ValueError(f"the samples{f' of {k}' if k else ''} are not numbered {self.first}, {self.first + 1}, ... once each")
        if not all_ and self.append:
            return self.abort(messages)
        if self.file:
            os.makedirs(self.new, exist_ok=True)
        else:
            with open(self.new, "ab"):
                pass
            if self.wav_rate:
                with open(self.new, "r+b") as f:
                    f.write(wav_header(sum(v[0] for v in all_.values()), self.wav_rate))
        gone = f"{self.new}-old"
        if self.file and os.path.exists(self.path):
            os.rename(self.path, gone)
        os.replace(self.new, self.path)
        shutil.rmtree(gone, ignore_errors=True)

    def abort(self, messages: list[Part]) -> None:
        if os.path.isdir(self.new):
            shutil.rmtree(self.new, ignore_errors=True)
        elif os.path.exists(self.new):
            os.unlink(self.new)


class DatStream(_Positions, DataSourceStreamArrowWriter):
    """Frames of a stream into one growing file, or one a session, at the place of their index: a batch that is repeated changes nothing."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        return self.put(iterator, self.path)

    def commit(self, messages: list[Part], batchId: int) -> None:
        pass  # what a task wrote is in its place

    def abort(self, messages: list[Part], batchId: int) -> None:
        pass  # the batch is repeated


class SigDat(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sigdat"

    def schema(self) -> str:
        kind = SPARK_TYPES[format_of(self.options.get("dtype", "int16")).str[1:]]
        return f"session string, sample_idx long, channel int, value {kind}" if self.options.get("layout") == "long" else f"session string, sample_idx long, x array<{kind}>"

    def reader(self, schema) -> DatReader:
        return DatReader(self.options)

    def writer(self, schema, overwrite: bool) -> DatWriter:
        return DatWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> DatStream:
        return DatStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SigDat)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_dat(spark: SparkSession, path: str, nch: int, **options: object) -> DataFrame:
    """A recording, or all of a folder or glob: a session is the name of the folder a file lies in, and has one file (option ``file``)."""
    register(spark)
    return spark.read.format("sigdat").options(nch=nch, **options).load(path)


def write_dat(frames: DataFrame, path: str, dtype: str = "int16", mode: str = "overwrite", first: int | None = None, **options: object) -> None:
    """frames(sample_idx, x) as interleaved samples; values are rounded and saturated, a null is 0.

    ``first`` is the index of the first frame, found by a pass where it is not given.
    """
    register(frames.sparkSession)
    if first is None:
        first = frames.agg(F.min("sample_idx")).first()[0] or 0
    rows = frames.select("sample_idx", "x").repartitionByRange("sample_idx").sortWithinPartitions("sample_idx")
    rows.write.format("sigdat").options(dtype=dtype, first=first, **options).mode(mode).save(path)


def write_recordings(frames: DataFrame, path: str, file: str = "amplifier.dat", dtype: str = "int16", first: int = 0) -> None:
    """frames(session, sample_idx, x) as a folder with a file for each session, in one job; a long session is written by many tasks."""
    register(frames.sparkSession)
    keys = ["session", "sample_idx"]
    rows = frames.select(*keys, "x").repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.format("sigdat").options(dtype=dtype, first=first, file=file).mode("overwrite").save(path)


def stream_dat(frames: DataFrame, path: str, checkpoint: str, dtype: str = "int16", first: int = 0, file: str | None = None, **trigger: object):
    """A started query that writes a stream of frames([session,] sample_idx, x) into a growing file, or one a session."""
    register(frames.sparkSession)
    options = {"dtype": dtype, "first": first} | ({"file": file} if file else {})
    rows = frames.select(*(["session"] if file else []), "sample_idx", "x")
    return rows.writeStream.format("sigdat").options(**options).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)


def write_index(spark: SparkSession, n: int, path: str) -> None:
    """time.dat: 0..n-1 as 32-bit integers."""
    write_dat(spark.range(n).select(F.col("id").alias("sample_idx"), F.array("id").alias("x")), path, "int32", first=0)


def read_audio(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """adc.dat: unsigned 16-bit mono; ``pcm`` is the signed sample."""
    from sigspark.functions.columns import audio_sample

    raw = read_dat(spark, path, 1, dtype="uint16", **options)
    return raw.select("session", "sample_idx", F.get("x", F.lit(0)).alias("u")).withColumn("pcm", audio_sample("u"))
