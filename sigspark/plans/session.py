"""Batch pre-processing of one recording session (a folder of fixed-named files)."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.functions import columns as C
from sigspark.operators import events as E
from sigspark.operators import ordered as O
from sigspark.operators import signals as S
from sigspark.sources import dat, header, rhd

LFP_RATE = 1250
IMU_RATE = 100
#: 1-based analog channels of the digital word, the inertial axes and the electrode stand-ins.
DIGITAL, INERTIAL, STAND_IN = 1, list(range(2, 11)), [5, 6]
FILES = {"amplifier": "amplifier.dat", "analog": "analogin.dat", "params": "CE_params.bin"}
#: Digital inputs (bits) of the stimulation triggers; those of the first are detections, those of the second stimulations.
STIM_BITS, DETECT_BIT, DELIVERED_BIT = (0, 1, 2, 3), 0, 1


@dataclass
class Session:
    """Lazily evaluated outputs of a session; nothing is computed until one is written or collected."""

    mode: dict
    lfp: DataFrame
    combined: DataFrame
    edges: DataFrame
    events: DataFrame
    stimulation: DataFrame
    detected_only: DataFrame
    #: None where the analog file has no room for nine axes.
    imu: DataFrame | None


def long_form(wide: DataFrame, name: str = "x") -> DataFrame:
    return wide.select("session", "sample_idx", F.posexplode(name).alias("channel", "value")).withColumn("value", F.col("value").cast("double"))


def lfp_rows(wide: DataFrame, fs: int, cutoff: float = 0.5, compat: bool = False) -> DataFrame:
    """(session, sample_idx, y): the samples of all channels at the LFP rate, high-passed forward and backward, of whole recordings; read once.

    compat designs the filter at the recording's own rate, as the tool did.
    """
    keys = ["session"]
    slow = S.resample(wide, keys, "sample_idx", "x", LFP_RATE, fs, first=0)
    return S.zero_phase_filter(slow, keys, "sample_idx", "y", cutoff, LFP_RATE, "high", fs if compat else None)


def lfp(wide: DataFrame, fs: int, cutoff: float = 0.5, compat: bool = False) -> DataFrame:
    """(session, channel, sample_idx, y): ``lfp_rows`` with a row for each channel."""
    rows = lfp_rows(wide, fs, cutoff, compat)
    return rows.select("session", "sample_idx", F.posexplode("y").alias("channel", "y")).select("session", "channel", "sample_idx", "y")


def device_events(edges: DataFrame) -> DataFrame:
    """(session, bit, phase, time, description) of digital edges; times count samples from 1."""
    out = edges.withColumn("time", F.col("tick") / LFP_RATE)
    return E.labelled(out.withColumn("channel", F.col("bit") + 1), "DigitIn").drop("channel", "tick")


def stimulation_events(events: DataFrame, interval_ms: list[float], per_channel: bool = False) -> DataFrame:
    """Stimulation starts more than the interval after the trigger before; the first interval serves all channels unless asked otherwise.

    Intervals are milliseconds, as in the header; times are seconds. The first trigger is compared with time 0.
    """
    starts = E.starts(events).where(F.col("bit").isin(*STIM_BITS))
    gap = F.get(F.array(*(F.lit(ms / 1000) for ms in interval_ms)), F.col("bit") if per_channel else F.lit(0))
    out = O.first_difference(starts, ["session", "bit"], ["time"], "time", 0.0, "_gap").where(F.col("_gap") > gap).drop("_gap")
    return E.labelled(out.withColumn("channel", F.col("bit") + 1), "StimOn").drop("channel")


def detected_only(stimulation: DataFrame, compat: bool = False) -> DataFrame:
    """Starts of the first stimulation list at whose time the second has none.

    compat takes every other event of both lists, which hold starts only, and names the last channel, as the tool did.
    """
    micro = stimulation.withColumn("us", F.round(F.col("time") * 1_000_000).cast("long"))
    one, two = (micro.where(F.col("bit") == b) for b in (DETECT_BIT, DELIVERED_BIT))
    if compat:
        one, two = (O.every_other(x, ["session"], ["time"]) for x in (one, two))
    out = E.detect_only(one, two, ["session", "us"]).drop("us")
    return E.labelled(out.withColumn("channel", F.lit(STIM_BITS[-1] + 1) if compat else F.col("bit") + 1), "Detect").drop("channel")


def scale_axes(df: DataFrame, axes: str = "x", n_axes: int = 9) -> DataFrame:
    """df with its raw axes as columns in units: nine as acc, gyr and mag, three as acc of the older device."""
    if n_axes not in (3, 9):
        raise ValueError("there are 3 or 9 axes")
    rest = [c for c in df.columns if c != axes]
    return df.select(*rest, (C.imu_scaled if n_axes == 9 else C.imu3_scaled)(axes).alias("_s")).select(*rest, "_s.*")


def imu(analog: DataFrame, fs: int = LFP_RATE, rate: int = IMU_RATE) -> DataFrame:
    """(session, sample_idx, t, q, R, accel_*, speed_*): inertial axes resampled, scaled, calibrated and fused."""
    keys = ["session"]
    names = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]
    nine = analog.select(*keys, "sample_idx", C.channels("x", INERTIAL).alias("x"))
    wide = S.resample(nine, keys, "sample_idx", "x", rate, fs, first=0).withColumnRenamed("y", "x")
    # read twice and more by the statistics and filters that follow; at this rate it is a twelfth of the recording
    wide = scale_axes(wide).persist(StorageLevel.DISK_ONLY)
    wide = S.calibrate(wide, keys, names[:3], names[3:6])
    fused = S.fuse_orientation(wide, keys, "sample_idx", rate)
    q = [F.get("q", F.lit(i)) for i in range(4)]
    fused = fused.withColumn("R", C.quaternion_matrix(*q))
    fused = fused.withColumn("w", C.rotated("R", F.col("acc_x"), F.col("acc_y"), F.col("acc_z"))).select(*keys, "sample_idx", "q", "R", *(F.col(f"w.{a}").alias(f"accel_{a}") for a in "xyz")).persist(StorageLevel.DISK_ONLY)
    still = S.remove_median(fused, keys, [f"accel_{a}" for a in "xyz"])
    out = still.select(*keys, "sample_idx", C.seconds_of("sample_idx", rate).alias("t"), "q", "R", *(f"accel_{a}" for a in "xyz")).persist(StorageLevel.DISK_ONLY)
    axes = F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(f"accel_{a}").alias("v")) for a in "xyz")))
    long = out.select(*keys, "sample_idx", axes.alias("a")).select(*keys, "a.axis", "sample_idx", (F.col("a.v") / rate).alias("v"))
    summed = O.running_sum(long, [*keys, "axis"], "sample_idx", "v", "s").select(*keys, "axis", "sample_idx", F.col("s").alias("v"))
    speed = S.zero_phase_filter(summed, [*keys, "axis"], "sample_idx", "v", 0.1, rate, "high")
    speed = S.pivot_channels(speed, [*keys, "sample_idx"], "axis", "y", list("xyz")).withColumnsRenamed({a: f"speed_{a}" for a in "xyz"})
    return out.join(speed, [*keys, "sample_idx"])


def acceleration(analog: DataFrame, channels: list[int], fs: int = LFP_RATE, rate: int = IMU_RATE) -> DataFrame:
    """(session, sample_idx, t, acc_*) of a device with three axes, at the given 1-based analog channels: resampled and scaled, not fused."""
    if len(channels) != 3:
        raise ValueError("there are three axes")
    slow = S.resample(analog.select("session", "sample_idx", C.channels("x", channels).alias("x")), ["session"], "sample_idx", "x", rate, fs, first=0)
    scaled = scale_axes(slow.withColumnRenamed("y", "x"), n_axes=3)
    return scaled.select("session", "sample_idx", C.seconds_of("sample_idx", rate).alias("t"), "acc_x", "acc_y", "acc_z")


def preprocess(spark: SparkSession, folder: str, compat: bool = False) -> Session:
    """All products of a session folder. A missing file is an error."""
    path = {k: os.path.join(folder, f) for k, f in FILES.items()}
    with open(path["params"], "rb") as f:
        system, _ = header.parse(f.read())
    mode = header.recording_mode(system["fs"], system["Nch"]) | {"cl_mode": system["cl_mode"]}
    analog = dat.read_dat(spark, path["analog"], mode["analog_channels"])
    raw = analog.withColumn("x", C.channels("x", STAND_IN)) if mode["from_analog"] else dat.read_dat(spark, path["amplifier"], mode["nch"])
    fs = LFP_RATE if mode["from_analog"] else mode["fs"]
    slow = lfp(raw, fs, compat=compat)
    rows = lfp_rows(raw, fs, compat=compat).select("session", "sample_idx", F.transform("y", C.saturate_int16).alias("lfp"))
    combined = S.zip_signals(rows, analog, ["session"], "sample_idx").select("session", "sample_idx", F.concat("lfp", "x").alias("x"))
    words = analog.select("session", "sample_idx", C.unsigned16(F.element_at("x", DIGITAL)).alias("word"))
    edges = O.word_edges(words, ["session"], "sample_idx", "word")
    events = device_events(edges)
    stimulation = stimulation_events(events, system["stim_interval"])
    detected = detected_only(stimulation, compat)
    axes = imu(analog) if mode["analog_channels"] >= INERTIAL[-1] else None
    return Session(mode, slow, combined, edges, events, stimulation, detected, axes)


#: The file that says what a table was made from.
MADE_FROM = "_made_from"


def fingerprint(folder: str) -> str:
    """Names, sizes and times of a session's input files."""
    found = [os.stat(os.path.join(folder, f)) if os.path.exists(os.path.join(folder, f)) else None for f in FILES.values()]
    return " ".join(f"{f}:{s.st_size}:{s.st_mtime_ns}" if s else f"{f}:none" for f, s in zip(FILES.values(), found, strict=True))


def is_done(path: str, made_from: str) -> bool:
    """Whether a table was written to its end, from these inputs."""
    mark = os.path.join(path, MADE_FROM)
    if not os.path.exists(os.path.join(path, "_SUCCESS")) or not os.path.exists(mark):
        return False
    with open(mark, encoding="utf-8") as f:
        return f.read() == made_from


def export(session: Session, spark: SparkSession, folder: str) -> None:
    """Files beside the recording: time.dat, info.rhd, amplifier_cat.lfp; tables as Parquet.

    A table that was written to its end from the same input files is left alone;
    one that was broken off, or made from other files, is written again.
    """
    n = session.combined.count()
    dat.write_index(spark, n, os.path.join(folder, "time.dat"))
    rhd.write_header(os.path.join(folder, "info.rhd"), fs=session.mode["fs"], nch=session.mode["nch"], cl_mode=session.mode["cl_mode"])
    dat.write_dat(session.combined, os.path.join(folder, "amplifier_cat.lfp"), first=0)
    made_from = fingerprint(folder)
    for name in ("lfp", "events", "stimulation", "detected_only", "imu"):
        path = os.path.join(folder, name)
        if getattr(session, name) is None or is_done(path, made_from):
            continue
        getattr(session, name).write.mode("overwrite").parquet(path)
        with open(os.path.join(path, MADE_FROM), "w", encoding="utf-8") as f:
            f.write(made_from)
