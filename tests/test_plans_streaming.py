import os
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sigspark.functions import kernels as K
from sigspark.operators import ordered as O
from sigspark.plans import media, registry, session
from sigspark.sources import header
from sigspark.streaming import live

from .test_sources import make, raw_frame

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(None if v is None or v != v else round(float(v), 6) if isinstance(v, (float, np.floating)) else str(v) for v in r) for r in df.itertuples(index=False)), key=key)


def key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    assert len(got)
    if name in registry.ORACLE:
        want = con.execute(registry.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(key, rows(got))) == sorted(map(key, rows(want)))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def build_session(folder, fs=20000, nch=64, n=2500):
    rng = np.random.default_rng(8)
    word = np.zeros(n, int)
    for at, bit in ((0, 0), (100, 0), (400, 0), (700, 13), (100, 13), (n - 5, 15)):
        word[at : at + 20] |= 1 << bit
    analog = rng.integers(-100, 100, (n, 16 if nch == 64 else 8))
    analog[:, 0] = np.where(word >= 32768, word - 65536, word)
    if nch == 64:
        analog[:, 3] += 4000
    make(f"{folder}/analogin.dat", analog.reshape(-1))
    if fs:
        make(f"{folder}/amplifier.dat", rng.integers(-3000, 3000, (n * fs // 1250, nch)).reshape(-1))
    with open(f"{folder}/CE_params.bin", "wb") as f:
        f.write(header.pack({"fs": fs, "Nch": nch, "stim_interval": [100, 9, 9, 9]}, header.SYSTEM_FIELDS))


def test_session(spark, tmp_path):
    folder = f"{tmp_path}/rec"
    build_session(folder, nch=64, fs=2500, n=1500)
    s = session.preprocess(spark, folder)
    assert s.lfp.count() == 64 * 1500 and s.combined.count() == 1500
    assert len(s.combined.first().x) == 80
    got = {(r.bit, r.phase, round(r.time * 1250)) for r in s.events.collect()}
    assert {(0, "start", 1), (0, "start", 101), (0, "end", 121), (13, "start", 701), (15, "end", 1501)} <= got
    assert [round(r.time * 1250) for r in s.stimulation.orderBy("time").collect()] == [401]
    assert [(r.bit, round(r.time * 1250), r.description) for r in s.detected_only.collect()] == [(0, 401, "Detect start 1")]
    imu = s.imu.orderBy("sample_idx").collect()
    assert len(imu) == 120 and np.allclose([np.linalg.norm(r.q) for r in imu], 1)
    session.export(s, spark, folder)
    assert os.path.getsize(f"{folder}/amplifier_cat.lfp") == 1500 * 80 * 2 and os.path.getsize(f"{folder}/time.dat") == 6000


@pytest.mark.parametrize("nch", [32, 64])
def test_session_without_electrodes(spark, tmp_path, nch):
    """Without a rate there are two stand-ins and 8 analog channels, also if the header says 64."""
    folder = f"{tmp_path}/rec"
    build_session(folder, fs=0, nch=32, n=600)
    with open(f"{folder}/CE_params.bin", "wb") as f:
        f.write(header.pack({"fs": 0, "Nch": nch, "stim_interval": [100, 9, 9, 9]}, header.SYSTEM_FIELDS))
    s = session.preprocess(spark, folder)
    assert s.mode["from_analog"] and s.mode["analog_channels"] == 8 and s.lfp.select("channel").distinct().count() == 2
    assert s.combined.count() == 600 and len(s.combined.first().x) == 10 and s.imu is None
    session.export(s, spark, folder)
    assert os.path.getsize(f"{folder}/amplifier_cat.lfp") == 600 * 10 * 2


def triggers(spark, *lists):
    return spark.createDataFrame([("s", bit, "start", t) for bit, times in lists for t in times], "session string, bit int, phase string, time double")


def test_stimulations_and_detections(spark):
    """Intervals in milliseconds; detected only: times of the first list that the second has not."""
    events = triggers(spark, (0, [0.05, 0.48, 0.5, 0.96, 1.44]), (1, [0.48, 0.96]), (13, [0.2, 0.7]))
    stim = session.stimulation_events(events, [100.0, 9, 9, 9])
    assert sorted((r.bit, r.time) for r in stim.collect()) == [(0, 0.48), (0, 0.96), (0, 1.44), (1, 0.48), (1, 0.96)]
    assert sorted((r.time, r.description) for r in session.detected_only(stim).collect()) == [(1.44, "Detect start 1")]
    # every other of (0.48, 0.96, 1.44) less every other of (0.48, 0.96)
    assert sorted((r.time, r.description) for r in session.detected_only(stim, compat=True).collect()) == [(1.44, "Detect start 4")]
    own = session.stimulation_events(events, [100.0, 450.0, 9, 9], per_channel=True)
    assert sorted((r.bit, r.time) for r in own.collect()) == [(0, 0.48), (0, 0.96), (0, 1.44), (1, 0.48), (1, 0.96)]
    none = session.stimulation_events(events, [500.0] * 4)
    assert sorted((r.bit, r.time) for r in none.collect()) == []


def test_axes_by_their_number(spark):
    df = spark.createDataFrame([(1, [16384.0] * 9)], "k long, x array<double>")
    assert len(session.scale_axes(df).columns) == 10
    three = session.scale_axes(df.withColumn("x", F.slice("x", 1, 3)), n_axes=3)
    assert three.columns == ["k", "acc_x", "acc_y", "acc_z"] and abs(three.first().acc_x - 16384 / 65535 * 2) < 1e-9
    with pytest.raises(ValueError, match="axes"):
        session.scale_axes(df, n_axes=6)


def test_listed_pixels_are_repaired_by_default(spark, tmp_path):
    image = np.full((320, 320), 400)
    bad = [divmod(n - 1, 320) for n in K.BAD_PIXELS]
    for r, c in bad:
        image[r, c] = 1020
    os.makedirs(tmp_path, exist_ok=True)
    with open(f"{tmp_path}/misc.dat", "wb") as f:
        f.write(raw_frame(image))
    done = [np.frombuffer(media.video(spark, f"{tmp_path}/misc.dat", *x).first().rgb, np.uint8) for x in ((), (None,))]
    assert (done[0] == 160).all() and (done[1] > 160).any()


def test_media(spark, tmp_path):
    make(f"{tmp_path}/s/adc.dat", np.random.default_rng(3).integers(0, 65536, 4000), "<u2")
    sound = media.audio(spark, f"{tmp_path}/s/adc.dat")
    assert sound.count() == 4000 and media.slow_audio(sound).count() == 1200
    with open(f"{tmp_path}/misc.dat", "wb") as f:
        f.write(raw_frame(np.full((320, 320), 400)) * 2)
    images = media.video(spark, f"{tmp_path}/misc.dat")
    assert [r.t for r in images.orderBy("frame_idx").collect()] == [0.0, 1 / 16]
    assert media.with_audio(images, sound).where("frame_idx = 0").count() == 4000


def drain(spark, stream, name, tmp_path):
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).toPandas()


def test_live_frames(spark, tmp_path):
    path = f"{tmp_path}/misc.dat"
    with open(path, "wb") as f:
        f.write(raw_frame(np.full((320, 320), 400)) * 3)
    q = media.preview(spark, path).writeStream.format("memory").queryName("frames").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    assert spark.table("frames").count() == 3
    with open(path, "ab") as f:
        f.write(raw_frame(np.zeros((320, 320), int)) + b"partial")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.frame_idx for r in spark.table("frames").collect()) == [0, 1, 2, 3]


@pytest.fixture
def batches(spark, tmp_path):
    """A recording of 3 keys in 5 files that arrive in order."""
    rng = np.random.default_rng(11)
    folder, schema = f"{tmp_path}/in", "k long, i long, t double, w long, v double"
    data, t = [], 0.0
    for i in range(200):
        for k in range(3):
            t += float(rng.uniform(0, 0.4))
            data.append((k, i, t, int(rng.integers(0, 65536)), float(rng.normal())))
    for part in range(5):
        df = spark.createDataFrame(data[part * 120 : part * 120 + 120], schema).orderBy(F.rand(part))
        df.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    live.use_state_store(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return spark.read.schema(schema).parquet(folder), stream


def test_streams_equal_batch(spark, batches, tmp_path):
    whole, stream = batches
    pairs = {
        "refractory": (O.greedy_refractory(whole, ["k"], ["t"], "t", 3.0), live.refractory_stream(stream, ["k"], "t", 3.0)),
        "iir": (O.iir_filter(whole, ["k"], ["i"], "v", *map(list, K.butter2(100, 1250, "low"))), live.iir_stream(stream, ["k"], "i", "v", *map(list, K.butter2(100, 1250, "low")))),
    }
    for name, (a, b) in pairs.items():
        a, b = a.toPandas(), drain(spark, b, name, tmp_path)
        assert rows(a) == rows(b)
    edges = drain(spark, live.edge_stream(stream, ["k"], "i", "w"), "edges", tmp_path)
    want = O.word_edges(whole, ["k"], "i", "w").where("phase = 'start' OR tick <= 200").toPandas()
    assert sorted(map(key, rows(edges))) == sorted(map(key, rows(want)))


def test_closed_loop(spark, tmp_path):
    df = spark.createDataFrame([(1, t / 10, v) for t, v in enumerate([0, 9, 9, 0, 9, 0, 0, 0, 0, 9, 0])], "k long, t double, v long")
    df.write.parquet(f"{tmp_path}/in")
    live.use_state_store(spark)
    out = drain(spark, live.closed_loop(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["k"], "t", "v", 5, 0.05, 0.01, 4, 0.1), "pulses", tmp_path)
    assert np.allclose(sorted(out[out.phase == "start"].time), [0.15, 0.25, 0.35, 0.45, 0.95, 1.05, 1.15, 1.25])


def test_windows(spark, tmp_path):
    e = spark.read.parquet(f"{DATA}/events.parquet")
    e.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in")
    got = drain(spark, live.frames_per_second(stream, "ts"), "fps", tmp_path)
    assert 0 < got.n_frames.sum() <= e.count()
    with pytest.raises(ValueError, match="preview"):
        live.preview(stream, "ts", 3, [])
    assert live.preview(stream, "ts", 5, [F.avg("value").alias("v")], 1).isStreaming


def test_a_table_that_was_broken_off_is_written_again(spark, tmp_path):
    folder = f"{tmp_path}/rec"
    build_session(folder, nch=64, fs=2500, n=300)
    s = session.preprocess(spark, folder)
    session.export(s, spark, folder)
    want = spark.read.parquet(f"{folder}/events").count()
    stamp = lambda: os.stat(f"{folder}/events/_SUCCESS").st_mtime_ns
    first = stamp()
    session.export(s, spark, folder)
    assert stamp() == first
    os.unlink(f"{folder}/events/_SUCCESS")  # as a run that was killed leaves it
    for f in os.listdir(f"{folder}/events"):
        if f.startswith("part-"):
            os.unlink(f"{folder}/events/{f}")
    session.export(s, spark, folder)
    assert spark.read.parquet(f"{folder}/events").count() == want
    second = stamp()
    os.utime(f"{folder}/analogin.dat")  # another recording in the same place
    session.export(s, spark, folder)
    assert stamp() > second


def test_three_axes(spark, tmp_path):
    from sigspark.functions import columns as C
    from sigspark.sources import dat

    x = np.random.default_rng(1).integers(-3000, 3000, (2500, 8))
    make(f"{tmp_path}/s/analogin.dat", x.reshape(-1))
    got = session.acceleration(dat.read_dat(spark, f"{tmp_path}/s/analogin.dat", 8), [2, 3, 4]).orderBy("sample_idx").toPandas()
    assert got.sample_idx.tolist() == list(range(200)) and np.allclose(got.t, np.arange(200) / 100)
    for i, a in enumerate("xyz"):
        assert np.allclose(got[f"acc_{a}"], K.resample(x[:, 1 + i], 100, 1250) * C.ACC3_SCALE)
    with pytest.raises(ValueError):
        session.acceleration(got, [1, 2])
