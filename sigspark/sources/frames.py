"""Raw camera frames: a batch and streaming data source ("sigframes").

Options: path (file, folder or glob, mounted or URI), file (pattern of a folder's files, default *.dat), frame_bytes (default 160,000), offset.
A truncated last frame is dropped. The stream reads the frames that a growing
file or folder has gained since the last batch, in order of file name; it never
opens anything for writing.

"sigslot" follows a device that writes one frame after another to the same
place (options path, offset, frame_bytes, poll_ms, frames_per_trigger, spool).
The driver polls the place; a poll that finds the frame of the poll before is a
repeat, told by its digest, one that finds no whole frame, or a frame that
changes while it is read, is lost and counted. A new frame goes into the
spool folder, which all executors have mounted, until its batch is committed:
a batch that is repeated has the same frames, and a restart repeats none.
"""

from __future__ import annotations

import hashlib
import os
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from sigspark.functions.kernels import FRAME_BYTES

from . import files

SCHEMA = "path string, frame_idx long, raw binary"
PER_PARTITION = 64


@dataclass
class Run(InputPartition):
    path: str
    first: int
    end: int


def _runs(path: str, first: int, end: int) -> list[Run]:
    return [Run(path, at, min(at + PER_PARTITION, end)) for at in range(first, end, PER_PARTITION)]


class _Frames:
    def __init__(self, options: dict):
        self.where, self.name = options["path"], options.get("file", "*.dat")
        self.size, self.offset = int(options.get("frame_bytes", FRAME_BYTES)), int(options.get("offset", 0))

    def counts(self) -> dict[str, int]:
        try:
            found = files.listed(self.where, self.name)
        except FileNotFoundError:
            found = []  # a stream may wait for its file
        return {p: max(0, n - self.offset) // self.size for p, n in found}

    def read(self, partition: Run) -> Iterator[tuple[str, int, bytes]]:
        if partition.end <= partition.first:
            return
        with files.opened(partition.path) as f:
            f.seek(self.offset + partition.first * self.size)
            for i in range(partition.first, partition.end):
                yield partition.path, i, f.read(self.size)


class FrameReader(_Frames, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return [r for p, n in self.counts().items() for r in _runs(p, 0, n)] or [Run("", 0, 0)]


class FrameStream(_Frames, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.counts()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [r for p, n in sorted(end.items()) for r in _runs(p, start.get(p, 0), n)] or [Run("", 0, 0)]


class SigFrames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sigframes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)

    def streamReader(self, schema) -> FrameStream:
        return FrameStream(self.options)


def read_frames(spark: SparkSession, path: str, **options: object) -> DataFrame:
    spark.dataSource.register(SigFrames)
    return spark.read.format("sigframes").options(**options).load(path)


def stream_frames(spark: SparkSession, path: str, **options: object) -> DataFrame:
    spark.dataSource.register(SigFrames)
    return spark.readStream.format("sigframes").options(**options).load(path)


SLOT_SCHEMA = "frame_idx long, poll long, lost long, raw binary"


@dataclass
class Held(InputPartition):
    first: int
    end: int


class SlotStream(DataSourceStreamReader):
    """Frames of a place that is written again and again; the offset is the number of frames seen."""

    def __init__(self, options: dict):
        self.path, self.offset, self.size = options["path"], int(options.get("offset", 0)), int(options.get("frame_bytes", FRAME_BYTES))
        self.wait, self.most = int(options.get("poll_ms", 20)) / 1000, int(options.get("frames_per_trigger", 64))
        self.spool = files.place(options["spool"])[1]
        self.thread: threading.Thread | None = None
        self.me, self.ended = uuid.uuid4().hex, False

    def __getstate__(self) -> dict:
        return self.__dict__ | {"thread": None}  # tasks read the spool only

    def _held(self) -> dict[int, tuple[str, int, int]]:
        """Frames in the spool: number -> (name, poll, lost)."""
        names = [n.removesuffix(".raw").split("-") for n in os.listdir(self.spool) if n.endswith(".raw")]
        return {int(n): (f"{self.spool}/{n}-{poll}-{lost}.raw", int(poll), int(lost)) for n, poll, lost in names}

    def _start(self) -> None:
        if self.thread is not None:
            return
        os.makedirs(self.spool, exist_ok=True)
        # one reader fills the spool: one of an earlier run that still lives sees that it is not it, and ends
        with open(f"{self.spool}/owner", "w", encoding="utf-8") as f:
            f.write(self.me)
        held = self._held()
        self.seen = max(held, default=-1) + 1
        self.given = min(held, default=0)
        self.polls, self.digest = 0, b""
        if held:
            name, self.polls, _ = held[self.seen - 1]
            with open(name, "rb") as f:
                self.digest = hashlib.sha256(f.read()).digest()
            self.polls += 1
        self.thread = threading.Thread(target=self._follow, daemon=True)
        self.thread.start()

    def _look(self) -> bytes | None:
        """The frame in the place, if it is whole and the same when read again."""
        try:
            with open(self.path, "rb") as f:
                found = []
                for _ in range(2):
                    f.seek(self.offset)
                    found.append(f.read(self.size))
        except OSError:
            return None
        return found[0] if len(found[0]) == self.size and found[0] == found[1] else None

    def _mine(self) -> bool:
        try:
            with open(f"{self.spool}/owner", encoding="utf-8") as f:
                return f.read() == self.me
        except OSError:
            return False

    def stop(self) -> None:
        self.ended = True

    def _follow(self) -> None:
        lost = 0
        while not self.ended and self._mine():
            raw = self._look()
            if raw is None:
                lost += 1
            elif (digest := hashlib.sha256(raw).digest()) != self.digest:
                name = f"{self.spool}/{self.seen}-{self.polls}-{lost}"
                with open(f"{name}.new", "wb") as f:
                    f.write(raw)
                os.rename(f"{name}.new", f"{name}.raw")
                self.digest, self.seen, lost = digest, self.seen + 1, 0
            self.polls += 1
            time.sleep(self.wait)

    def initialOffset(self) -> dict:
        self._start()
        return {"n": min(self._held(), default=0)}

    def latestOffset(self) -> dict:
        self._start()
        return {"n": min(self.seen, self.given + self.most)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self._start()  # a restart plans its last batch again before it asks for more
        self.given = max(self.given, end["n"])
        return [Held(at, min(at + PER_PARTITION, end["n"])) for at in range(start["n"], end["n"], PER_PARTITION)] or [Held(0, 0)]

    def read(self, partition: Held) -> Iterator[tuple[int, int, int, bytes]]:
        held = self._held() if partition.end > partition.first else {}
        for i in range(partition.first, partition.end):
            name, poll, lost = held[i]
            with open(name, "rb") as f:
                yield i, poll, lost, f.read()

    def commit(self, end: dict) -> None:
        # the last frame stays: a restart compares the place with it
        for i, (name, _, _) in self._held().items():
            if i < end["n"] - 1:
                os.unlink(name)


class SigSlot(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sigslot"

    def schema(self) -> str:
        return SLOT_SCHEMA

    def streamReader(self, schema) -> SlotStream:
        return SlotStream(self.options)


def stream_slot(spark: SparkSession, path: str, spool: str, **options: object) -> DataFrame:
    """(frame_idx, poll, lost, raw) of the frames that follow one another in one place of a file or device."""
    spark.dataSource.register(SigSlot)
    return spark.readStream.format("sigslot").options(path=path, spool=spool, **options).load()
