"""Live forms against their batch forms, for random cuts of the input and after restarts."""

import datetime as dt
import json
import os
import random
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.functions import kernels as K
from sigspark.operators import ordered as O
from sigspark.operators import signals as S
from sigspark.sources import frames as fs
from sigspark.streaming import live

SCHEMA = "k string, i long, v double"


def drain(spark, stream, folder, name):
    """What a stream gives until its input is read, through a checkpoint."""
    out = f"{folder}/{name}"
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    return spark.read.schema(stream.schema).parquet(out)


def arrive(spark, parts, schema, folder):
    """A file for each part, in order of time."""
    os.makedirs(folder, exist_ok=True)
    at = len(os.listdir(folder))
    for n, part in enumerate(parts, at):
        df = spark.createDataFrame(part, schema)
        df.coalesce(1).write.parquet(f"{folder}/{n:03}")
        stamp = 1_700_000_000 + n * 10
        for f in os.listdir(f"{folder}/{n:03}"):
            os.utime(f"{folder}/{n:03}/{f}", (stamp, stamp))


def stream_of(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def cut(rows, seed, n):
    rng = random.Random(seed)
    at = sorted(rng.sample(range(1, len(rows)), n - 1))
    parts = [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)])]
    for p in parts:
        rng.shuffle(p)
    return parts


@pytest.fixture(scope="module")
def signal_rows():
    rng = np.random.default_rng(5)
    rows, n = [], {"a": 0, "b": 0}
    for _ in range(420):
        k = rng.choice(["a", "a", "b"])
        rows.append((str(k), n[k], None if rng.random() < 0.05 else float(rng.normal())))
        n[k] += 1
    return rows


def same(a, b, on, columns):
    a, b = ({tuple(r[c] for c in on): [r[c] for c in columns] for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys()
    flat = lambda d: np.array([[np.nan if v is None else v for v in d[k]] for k in sorted(d)], float)
    assert np.allclose(flat(a), flat(b), atol=1e-9, equal_nan=True)


FORMS = {
    "fir": (lambda d: O.fir(d, ["k"], "i", "v", [0.5, -1.0, 2.0, 0.25]), lambda d: live.fir_stream(d, ["k"], "i", "v", [0.5, -1.0, 2.0, 0.25]), ["y"]),
    "average": (lambda d: O.moving_average(d, ["k"], "i", "v", 7), lambda d: live.moving_average_stream(d, ["k"], "i", "v", 7), ["y"]),
    "envelope": (lambda d: S.envelope(d, ["k"], "i", "v"), lambda d: live.envelope_stream(d, ["k"], "i", "v"), ["envelope"]),
}


@pytest.mark.parametrize("name", sorted(FORMS))
def test_filters_with_tails(spark, tmp_path, signal_rows, name):
    batch, stream, columns = FORMS[name]
    live.use_state_store(spark)
    parts = cut(signal_rows, len(name), 4)
    arrive(spark, parts[:2], SCHEMA, f"{tmp_path}/in")
    drain(spark, stream(stream_of(spark, SCHEMA, f"{tmp_path}/in")), tmp_path, "out")
    arrive(spark, parts[2:], SCHEMA, f"{tmp_path}/in")  # the query starts again from its checkpoint
    got = drain(spark, stream(stream_of(spark, SCHEMA, f"{tmp_path}/in")), tmp_path, "out")
    same(got, batch(spark.createDataFrame(signal_rows, SCHEMA)), ["k", "i"], columns)


@pytest.mark.parametrize(("p", "q"), [(2, 25), (3, 2), (1, 4)])
def test_resampling_live(spark, tmp_path, signal_rows, p, q):
    live.use_state_store(spark)
    arrive(spark, cut(signal_rows, p, 5), SCHEMA, f"{tmp_path}/in")
    got = drain(spark, live.resample_stream(stream_of(spark, SCHEMA, f"{tmp_path}/in"), ["k"], "i", "v", p, q), tmp_path, "out")
    whole = S.resample(spark.createDataFrame(signal_rows, SCHEMA), ["k"], "i", "v", p, q)
    halo = len(K.resample_taps(p, q)) // (2 * p) + 1
    n = {k: sum(r[0] == k for r in signal_rows) for k in "ab"}
    done = {k: max(0, -(-(v - halo) * p // q)) for k, v in n.items()}
    want = whole.where(" OR ".join(f"(k = '{k}' AND i < {d})" for k, d in done.items()))
    same(got, want, ["k", "i"], ["y"])
    assert got.count() == sum(done.values()) > 0


def micros(us):
    return dt.timedelta(microseconds=us)


def seconds(s):
    return dt.datetime(2024, 5, 1, tzinfo=dt.UTC) + micros(round(s * 1e6))


def test_live_zip_equals_batch_and_forgets(spark, tmp_path):
    schema = "k string, i long, t timestamp, v double"
    left = [("ab"[i % 2], i // 2, seconds(i / 10), float(i)) for i in range(300)]
    right = [(k, i, t + micros(300_000), -v) for k, i, t, v in left if i % 5]
    arrive(spark, cut(left, 1, 6), schema, f"{tmp_path}/l")
    arrive(spark, cut(right, 2, 6), schema, f"{tmp_path}/r")
    a, b = (stream_of(spark, schema, f"{tmp_path}/{s}") for s in "lr")
    zipped = live.zip_live(a, b.withColumnsRenamed({"t": "rt", "v": "w"}), ["k"], "i", "t", "rt", "10 seconds", "1 second")
    out = f"{tmp_path}/out"
    q = zipped.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    kept = [sum(s.get("numRowsTotal", 0) for s in p["stateOperators"]) for p in (json.loads(p.json) for p in q.recentProgress)]
    got = spark.read.schema(zipped.schema).parquet(out)
    whole = S.zip_signals(spark.createDataFrame(left, schema), spark.createDataFrame([(r[0], r[1], r[3]) for r in right], "k string, i long, w double"), ["k"], "i")
    same(got, whole, ["k", "i"], ["v", "w"])
    assert kept[-1] < max(kept) < len(left) + len(right)


def test_frames_attached_live(spark, tmp_path):
    sounds = [("a", i, seconds(i / 100), float(i)) for i in range(200)]
    images = [("a", f, seconds(f / 10), 100.0 + f) for f in range(15)]
    arrive(spark, cut(sounds, 3, 4), "k string, i long, t timestamp, v double", f"{tmp_path}/s")
    arrive(spark, cut(images, 4, 3), "k string, frame_idx long, ft timestamp, image double", f"{tmp_path}/f")
    a, b = stream_of(spark, "k string, i long, t timestamp, v double", f"{tmp_path}/s"), stream_of(spark, "k string, frame_idx long, ft timestamp, image double", f"{tmp_path}/f")
    got = drain(spark, live.attach_frames_live(a, b, ["k"], "i", 10, "t", "ft", "1 minute", "1 second"), tmp_path, "out")
    assert sorted((r.i, r.image) for r in got.collect()) == [(i, 100.0 + i // 10) for i in range(150)]


def test_activity_equals_gaps_and_islands(spark, tmp_path):
    rng = random.Random(9)
    rows, t = [], 0.0
    for i in range(200):
        t += rng.choice([0.2, 0.5, 1.0, 6.0, 30.0])
        rows.append((rng.choice("ab"), seconds(t)))
    late = [rows.pop(50), rows.pop(90)]
    parts = cut(rows, 2, 6)
    parts[2] += late[:1]
    parts[4] += late[1:]
    parts.append([(k, seconds(t + 10_000)) for k in "ab"])  # closes all runs
    schema = "k string, t timestamp"
    arrive(spark, parts, schema, f"{tmp_path}/in")
    got = drain(spark, live.activity(stream_of(spark, schema, f"{tmp_path}/in"), ["k"], "t", "5 seconds", "1000 seconds"), tmp_path, "out")
    want = []
    for k in "ab":
        own = sorted(x for part in parts[:-1] for j, x in part if j == k)
        at = [0, *(i for i in range(1, len(own)) if own[i] - own[i - 1] >= micros(5_000_000)), len(own)]
        want += [(k, own[a].timestamp(), own[b - 1].timestamp(), b - a) for a, b in zip(at, at[1:])]
    found = sorted((r.k, r.a, r.b, r.n) for r in got.select("k", F.unix_micros("start").alias("a"), F.unix_micros("last").alias("b"), "n").collect())
    assert found == sorted((k, round(a * 1e6), round(b * 1e6), n) for k, a, b, n in want)


def oracle(rows, level, width, quiet, **plan):
    """All pulses of a key's rows in order of time."""
    out, high, busy = [], False, None
    for us, v in sorted(rows):
        now = v > level
        if now and not high and (busy is None or us >= busy):
            pulses = live.train(us, **plan)
            out += pulses
            busy = max([us, *(p + width for p in pulses)]) + quiet
        high = now
    return out


PLAN = {"delay": 0.05, "count": 4, "period": 0.3, "random_delay": 0.2, "train_start": 0.1, "train_duration": 0.9}


def test_trains():
    assert live.train(1_000_000, 0.5, 3, 0.25) == [1_500_000, 1_750_000, 2_000_000]
    assert live.train(0, 0.0, 10, 0.1, train_start=0.25, train_duration=0.3) == [300_000, 400_000, 500_000]
    a, b = live.train(7, 0.0, 1, 1, random_delay=1.0), live.train(7, 0.0, 1, 1, random_delay=1.0)
    assert a == b and 7 <= a[0] <= 1_000_007 and live.train(8, 0.0, 1, 1, random_delay=1.0) != [a[0] + 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_pulses_leave_when_their_time_has_come(spark, tmp_path, seed):
    """Rows out of order within the watermark, in random batches, with a restart: as the batch oracle."""
    rng = random.Random(seed)
    live.use_state_store(spark)
    rows = [(rng.choice("ab"), round(i * 100_000 + rng.randrange(50_000)), rng.choice([0.0, 0.0, 9.0])) for i in range(240)]
    order = sorted(range(len(rows)), key=lambda i: i + rng.random() * 15)  # at most about 1.5 seconds late
    moved = [rows[i] for i in order]
    schema = "k string, t timestamp, v double"
    base = seconds(0)
    as_rows = lambda part: [(k, base + micros(us), v) for k, us, v in part]
    parts = [as_rows(p) for p in cut(moved, seed, 7)]
    make = lambda: live.closed_loop_trains(stream_of(spark, schema, f"{tmp_path}/in"), ["k"], "t", "v", 5, width=0.01, watermark="3 seconds", quiet=0.1, **PLAN)
    arrive(spark, parts[:4], schema, f"{tmp_path}/in")
    first = drain(spark, make(), tmp_path, "out").select("k", F.unix_micros("time").alias("us"), "phase").collect()
    zero = round(base.timestamp() * 1e6)
    reached = max((r[1] - base) // micros(1) for p in parts[:4] for r in p) - 3_000_000
    assert first and max(r.us for r in first if r.phase == "start") - zero <= reached  # none is ahead of event time
    arrive(spark, [*parts[4:], [(k, seconds(1000), 0.0) for k in "ab"]], schema, f"{tmp_path}/in")
    got = drain(spark, make(), tmp_path, "out")
    found = sorted((r.k, r.us - zero) for r in got.where("phase = 'start'").select("k", F.unix_micros("time").alias("us")).collect())
    # the oracle's clock is the stream's: microseconds since 1970
    want = sorted((k, p - zero) for k in "ab" for p in oracle([(us + zero, v) for j, us, v in rows if j == k], 5, 10_000, 100_000, **PLAN))
    assert found == want
    ends = sorted((r.k, r.us - zero) for r in got.where("phase = 'end'").select("k", F.unix_micros("time").alias("us")).collect())
    assert ends == [(k, us + 10_000) for k, us in want]


def slot_query(spark, tmp_path, got, **options):
    df = fs.stream_slot(spark, f"{tmp_path}/slot", f"{tmp_path}/spool", frame_bytes=64, poll_ms=5, **options)

    def keep(batch, number):
        rows = batch.collect()
        got.append([(r.frame_idx, bytes(r.raw), r.lost) for r in rows])

    return df.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/check").trigger(processingTime="50 milliseconds").start()


def put(tmp_path, raw):
    with open(f"{tmp_path}/slot.new", "wb") as f:
        f.write(raw)
    os.replace(f"{tmp_path}/slot.new", f"{tmp_path}/slot")


def wait_for(condition, seconds_=60):
    end = time.monotonic() + seconds_
    while not condition():
        assert time.monotonic() < end, "took too long"
        time.sleep(0.02)


def test_a_slot_gives_each_frame_once(spark, tmp_path):
    """A device writes one frame over another; each is given once, repeats are none, lost polls are counted, a restart repeats none."""
    frame = lambda n: bytes([n]) * 64
    got, flat = [], lambda: [r for b in got for r in b]
    seen = lambda: max((int(n.split("-")[0]) for n in os.listdir(f"{tmp_path}/spool") if n.endswith(".raw")), default=-1) if os.path.isdir(f"{tmp_path}/spool") else -1

    def device(numbers, first):
        for at, n in enumerate(numbers, first):
            put(tmp_path, frame(n))
            wait_for(lambda: seen() >= at)

    q = slot_query(spark, tmp_path, got, frames_per_trigger=4)
    t = threading.Thread(target=device, args=(range(20), 0))
    t.start()
    t.join(90)
    put(tmp_path, frame(19))  # the same once more
    wait_for(lambda: len(flat()) == 20)
    put(tmp_path, b"short")
    time.sleep(0.3)
    put(tmp_path, frame(50))
    wait_for(lambda: len(flat()) == 21)
    q.stop()
    assert [(i, raw) for i, raw, _ in flat()] == [(i, frame(i)) for i in range(20)] + [(20, frame(50))]
    assert max(map(len, got)) <= 4 and flat()[-1][2] > 0
    # the device goes on, and the query starts again
    q = slot_query(spark, tmp_path, got)
    device([51, 52], 21)
    wait_for(lambda: len(flat()) == 23)
    q.stop()
    assert [i for i, _, _ in flat()] == list(range(23)) and [raw for _, raw, _ in flat()[21:]] == [frame(51), frame(52)]
    assert len([n for n in os.listdir(f"{tmp_path}/spool") if n.endswith(".raw")]) <= 4


def test_orientation_live(spark, tmp_path):
    from .test_signals import AXES, turning

    acc, gyr, mag, *_ = turning(200, 100.0)
    schema = "k string, i long, " + ", ".join(f"{n} double" for n in AXES)
    rows = [(k, i, *map(float, np.concatenate((acc[i], gyr[i], mag[i])))) for i in range(200) for k in "ab"]
    rows[0] = (*rows[0][:4], None, *rows[0][5:])
    live.use_state_store(spark)
    arrive(spark, cut(rows, 6, 4), schema, f"{tmp_path}/in")
    got = drain(spark, live.orientation_stream(stream_of(spark, schema, f"{tmp_path}/in"), ["k"], "i", 100.0), tmp_path, "out")
    whole = S.fuse_orientation(spark.createDataFrame(rows, schema), ["k"], "i", 100.0).select("k", "i", *(F.get("q", F.lit(j)).alias(n) for j, n in enumerate(["qw", "qx", "qy", "qz"])))
    same(got, whole, ["k", "i"], ["qw", "qx", "qy", "qz"])
