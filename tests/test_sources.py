import os
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.functions import kernels as K
from sigspark.operators import frames as V
from sigspark.sources import dat, header, rhd, text
from sigspark.sources import frames as fs


def make(path, values, dtype="<i2"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    np.asarray(values, dtype).tofile(path)
    return str(path)


@pytest.mark.parametrize(("nch", "frames"), [(1, 5000), (4, 9001), (64, 3)])
def test_scan_and_sink_are_inverse(spark, tmp_path, nch, frames):
    x = np.random.default_rng(nch).integers(-32768, 32768, (frames, nch))
    x[0, 0], x[-1, -1] = -32768, 32767
    path = make(f"{tmp_path}/s1/amplifier.dat", x.reshape(-1))
    with open(path, "ab") as f:
        f.write(b"\1" * (2 * nch - 1))  # a partial frame
    df = dat.read_dat(spark, path, nch, frames_per_partition=1000)
    got = df.orderBy("sample_idx").toPandas()
    assert (np.stack(got.x) == x).all() and set(got.session) == {"s1"} and (got.sample_idx == np.arange(frames)).all()
    dat.write_dat(df, f"{tmp_path}/out.dat")
    with open(f"{tmp_path}/out.dat", "rb") as f:
        assert f.read() == x.astype("<i2").tobytes()
    dat.write_dat(df, f"{tmp_path}/out.dat", mode="append")
    assert os.path.getsize(f"{tmp_path}/out.dat") == 2 * x.size * 2


def test_selection_range_and_layout(spark, tmp_path):
    x = np.arange(400).reshape(100, 4)
    path = make(f"{tmp_path}/s/a.dat", x.reshape(-1))
    got = dat.read_dat(spark, path, 4, select="3,1,3", start=-10, until=0).orderBy("sample_idx").toPandas()
    assert (np.stack(got.x) == x[-10:][:, [2, 0, 2]]).all()
    long = dat.read_dat(spark, path, 4, layout="long", start=2, until=3).toPandas()
    assert {(r.sample_idx, r.channel, r.value) for r in long.itertuples()} == {(i, c + 1, x[i, c]) for i in (2, 3) for c in range(4)}
    df = dat.read_dat(spark, path, 4, frames_per_partition=10).where((F.col("sample_idx") >= 25) & (F.col("sample_idx") < 41))
    assert df.count() == 16 and df.rdd.getNumPartitions() == 2
    for bad in ({"dtype": "int7"}, {"select": "5"}):
        with pytest.raises(Exception, match="unknown sample format|not all within"):
            dat.read_dat(spark, path, 4, **bad).count()


@pytest.mark.parametrize("name", ["uint8", "uint16", "uint32", "uint64", "int64", "single", "double"])
def test_formats(spark, tmp_path, name):
    kind = dat.format_of(name)
    x = np.array([0, 1, 5], kind) if kind.kind == "f" else np.array([0, np.iinfo(kind).max, np.iinfo(kind).min], kind)
    got = dat.read_dat(spark, make(f"{tmp_path}/s/a.dat", x, kind), 1, dtype=name).orderBy("sample_idx").toPandas()
    assert [int(v[0]) if kind.kind != "f" else float(v[0]) for v in got.x] == x.tolist()


def test_skip_and_many_files(spark, tmp_path):
    make(f"{tmp_path}/a/x.dat", [1, 99, 2, 99, 3, 99])
    make(f"{tmp_path}/b/x.dat", [7, 98])
    got = dat.read_dat(spark, f"{tmp_path}", 1, skip_bytes=2).toPandas()
    assert sorted((r.session, r.sample_idx, r.x[0]) for r in got.itertuples()) == [("a", 0, 1), ("a", 1, 2), ("a", 2, 3), ("b", 0, 7)]


def test_audio_and_index(spark, tmp_path):
    path = make(f"{tmp_path}/s/adc.dat", [0, 1, 32767, 32768, 65535], "<u2")
    got = dat.read_audio(spark, path).orderBy("sample_idx")
    assert [r.pcm for r in got.collect()] == [-32768, -32767, -1, 0, 32767]
    from sigspark.plans import media

    media.save_wav(got, f"{tmp_path}/a.wav")
    with wave.open(f"{tmp_path}/a.wav") as w:
        assert (w.getframerate(), w.getnchannels(), np.frombuffer(w.readframes(9), "<i2").tolist()) == (160_000, 1, [-32768, -32767, -1, 0, 32767])
    for n in (0, 1, 5000):
        dat.write_index(spark, n, f"{tmp_path}/time.dat")
        assert (np.fromfile(f"{tmp_path}/time.dat", "<i4") == np.arange(n)).all()


@pytest.mark.parametrize("blocks", [0, 1, 2])
def test_header(spark, tmp_path, blocks):
    assert struct.calcsize("<" + "".join(f"{n}{c}" for _, c, n in header.SYSTEM_FIELDS)) == 512
    value = iter(range(1, 2000))
    fill = lambda fields: {n: [next(value) % 200 for _ in range(k)] if k > 1 else next(value) % 200 for n, _, k in fields}
    system, dsp = fill(header.SYSTEM_FIELDS) | {"stim_interval": [0.5, 1, 2, 3]}, [fill(header.DSP_FIELDS) for _ in range(blocks)]
    with open(f"{tmp_path}/CE_params.bin", "wb") as f:
        f.write(header.pack(system, header.SYSTEM_FIELDS) + b"".join(header.pack(d, header.DSP_FIELDS) for d in dsp))
    row = header.read_header(spark, f"{tmp_path}/CE_params.bin").first()
    assert row.sys.asDict() == system and [d.asDict() for d in row.dsp] == dsp
    assert header.recording_mode(0, 64) == {"fs": 1250, "nch": 2, "analog_channels": 8, "from_analog": True}
    assert [header.recording_mode(*x)["analog_channels"] for x in ((20000, 64), (20000, 32), (0, 32))] == [16, 8, 8]
    with pytest.raises(ValueError, match="512"):
        header.parse(b"short")


@pytest.mark.parametrize("nch", [4, 64])
def test_vendor_header(spark, nch):
    data = rhd.header_bytes(20000, nch, 3)
    assert struct.unpack_from("<I2hfh", data) == (0xC6912702, 0, 0, 20000.0, 3)
    text_bytes = lambda s: len(rhd.q_string(s))
    rows = rhd.channel_table(spark, nch).collect()
    assert len(rows) == nch + nch // 4
    assert len(data) == 8 + 30 + 10 + 12 + 2 + sum(text_bytes(s) for s in ("Port A", "A", "ADC", "ADC")) + 12 + sum(2 * text_bytes(r.name) + 28 for r in rows)
    assert rhd.q_string("") == b"\0\0\0\0" and rhd.q_string("A") == b"\2\0\0\0A\0"


def test_metadata(spark, tmp_path):
    xml = '<p><nChannels>64</nChannels><samplingRate>20000</samplingRate><channel skip="0">5</channel><channel skip="1">9</channel><CHANNEL SKIP="0">2</CHANNEL></p>'
    (tmp_path / "a.xml").write_text(xml)
    row = text.read_metadata(spark, f"{tmp_path}/a.xml").first()
    assert (row.n_channels, row.fs, row.good_ch, row.ch_sel) == (64, 20000, [3, 6], [6, 3])
    (tmp_path / "a.nrs").write_text("<v><startTime>10</startTime><duration>77</duration><offset>-5</offset><offset>6</offset></v>")
    row = text.read_viewer(spark, f"{tmp_path}/a.nrs").first()
    assert (row.start_time, row.duration, row.offsets) == (10, 77, [-5, 6])
    make(f"{tmp_path}/a.lfp", range(11))
    row = text.sample_counts(spark, f"{tmp_path}/a.lfp", 2).first()
    assert (row.n_samples, row.fs) == (5, 1250)
    meta = text.read_metadata(spark, f"{tmp_path}/a.xml")
    chosen = meta.select("path", F.array(F.lit(4)).alias("ch_sel"))
    assert text.with_selection(meta, chosen).first().ch_sel == [4]


def raw_frame(pixels):
    p = pixels.reshape(-1, 2).astype(np.uint16)
    b = np.stack((p[:, 0] >> 3, ((p[:, 0] & 7) << 5) | (p[:, 1] >> 7), (p[:, 1] & 0x7F) << 1), 1).astype(np.uint8)
    lines = np.zeros((320, 492), np.uint8)
    lines[:, 12:] = b.reshape(320, 480)
    return lines.tobytes() + bytes(160_000 - 320 * 492)


def test_frames(spark, tmp_path):
    rng = np.random.default_rng(6)
    images = [np.zeros((320, 320), int), np.full((320, 320), 1023), np.add.outer(np.arange(320), np.arange(320)), rng.integers(0, 1024, (320, 320))]
    for m in images:
        assert (K.unpack10(K.deframe(raw_frame(m))).reshape(320, 320) == m).all()
    path = f"{tmp_path}/misc.dat"
    with open(path, "wb") as f:
        f.write(b"".join(map(raw_frame, images)) + b"\7" * 1000)
    rows = V.decode_frames(fs.read_frames(spark, path), [1, 2, 6500, 6501]).orderBy("frame_idx").collect()
    assert [r.frame_idx for r in rows] == [0, 1, 2, 3]
    assert not any(rows[0].rgb) and set(rows[1].rgb) == {160}
    assert abs(np.frombuffer(rows[3].rgb, np.uint8).mean() - 160) < 20


def test_letterbox():
    out = K.letterbox(np.full((10, 20, 3), 7, np.uint8), 40, 40)
    assert out.shape == (40, 40, 3) and (out[10:30] == 7).all() and (out[:10] == 0).all()
    ramp = np.tile(np.arange(8.0), (8, 1))
    assert np.allclose(K.letterbox(ramp, 8, 8), ramp)


def test_image_kernels():
    m = np.arange(64.0).reshape(8, 8)
    assert (np.rot90(np.rot90(m, 2), 2) == m).all()
    m[0, 1] = 1000
    fixed = K.repair(m, [2, 1])
    assert fixed[0, 1] == np.median(m[0:2, 0:3]) and fixed[0, 0] == np.median([0, fixed[0, 1], 8, 9])
    flat = K.demosaic(np.full((6, 6), 40))
    assert np.allclose(flat, 40)
    even = K.equalise(np.array([0, 0, 100, 200], np.uint8))
    assert even.tolist() == [0, 0, 128, 255] and (K.equalise(np.full(5, 9, np.uint8)) == 9).all()
    assert (K.brightness(np.zeros((2, 2))) == 0).all()
    rgb = K.equalise_luminance(np.random.default_rng(1).integers(0, 256, (4, 4, 3)))
    assert rgb.shape == (4, 4, 3) and rgb.dtype == np.uint8


def test_a_session_has_one_file(spark, tmp_path):
    for name in ("amplifier", "analogin"):
        make(f"{tmp_path}/recA/{name}.dat", range(8) if name == "amplifier" else range(100, 108))
    make(f"{tmp_path}/recB/amplifier.dat", range(4))
    with pytest.raises(Exception, match="one session"):
        dat.read_dat(spark, str(tmp_path), 1).count()
    got = dat.read_dat(spark, str(tmp_path), 1, file="amplifier.dat").collect()
    assert sorted((r.session, r.sample_idx, r.x[0]) for r in got) == [("recA", i, i) for i in range(8)] + [("recB", i, i) for i in range(4)]


def test_recordings_with_their_metadata(spark, tmp_path):
    xml = '<p><nChannels>4</nChannels><samplingRate>20000</samplingRate><channel skip="0">2</channel><channel skip="0">0</channel></p>'
    for name, n in (("a.dat", 83), ("a.lfp", 16)):
        make(f"{tmp_path}/{name}", np.zeros(n))
    (tmp_path / "a.xml").write_text(xml)
    make(f"{tmp_path}/b.dat", np.zeros(4))
    got = {os.path.basename(r.path): tuple(r)[1:] for r in text.recordings(spark, f"{tmp_path}/*.{{dat,lfp}}", f"{tmp_path}/*.xml").collect()}
    assert got == {"a.dat": (20, 4, 20000, [1, 3], [3, 1]), "a.lfp": (4, 4, 1250, [1, 3], [3, 1]), "b.dat": (None, None, None, None, None)}


def test_viewer_range(spark, tmp_path):
    (tmp_path / "v.nrs").write_text("<startTime>5000</startTime><duration>700</duration><offset>-3</offset>")
    for compat, until in ((False, 5700), (True, 10000)):
        assert text.read_viewer(spark, str(tmp_path / "v.nrs"), compat).first().until == until


def test_channel_records_are_the_headers_bytes(spark):
    rows = rhd.with_record(rhd.channel_table(spark, 1024)).where("n IN (1, 7, 64, 256, 300, 1000)").collect()
    assert len(rows) == 10 and all(bytes(r.record) == rhd._channel(r.n, r.kind, r.name) for r in rows)
    assert all(bytes(r.record) in rhd.header_bytes(20000, 1024) for r in rows)


def recording(spark, frames):
    return spark.createDataFrame(frames, "session string, sample_idx long, x array<double>").repartition(3)


def test_many_recordings_in_one_job(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = {"a": rng.integers(-40_000, 40_000, (500, 2)), "b": rng.integers(-9, 9, (1, 2)), "c": rng.integers(-9, 9, (77, 2))}
    rows = [(k, i, [float(v) + 0.25 for v in x[i]]) for k, x in data.items() for i in range(len(x))]
    rows[3][2][1] = None
    dat.write_recordings(recording(spark, rows), f"{tmp_path}/out", "x.dat")
    for k, x in data.items():
        want = np.clip(x, -32768, 32767)  # a quarter more is rounded away, beyond the ends as well
        if k == "a":
            want[3, 1] = 0
        assert (np.fromfile(f"{tmp_path}/out/{k}/x.dat", "<i2").reshape(-1, 2) == want).all()
    got = dat.read_dat(spark, f"file://{tmp_path}/out", 2, file="x.dat")
    assert got.rdd.getNumPartitions() == 1 and got.select("session").distinct().count() == 3
    # written again: the old folder is replaced as a whole
    dat.write_recordings(recording(spark, [("z", 5, [1.0]), ("z", 6, [2.0])]), f"{tmp_path}/out", "x.dat", first=5)
    assert os.listdir(f"{tmp_path}/out") == ["z"] and sorted(os.listdir(tmp_path)) == ["out"]
    assert np.fromfile(f"{tmp_path}/out/z/x.dat", "<i2").tolist() == [1, 2]


@pytest.mark.parametrize("bad", [[("a", 0, [1.0]), ("a", 2, [1.0])], [("a", 0, [1.0]), ("a", 0, [2.0])], [("a", 1, [1.0])], [("a", 0, [1.0]), ("a", 1, [1.0, 2.0])], [("../a", 0, [1.0])], [(None, 0, [1.0])], [("a", 0, None)], [("a", -1, [1.0])]])
def test_what_is_no_recording_leaves_the_old_one(spark, tmp_path, bad):
    make(f"{tmp_path}/out/a/x.dat", [7])
    with pytest.raises(Exception, match="numbered|same channels|no name|before"):
        dat.write_recordings(recording(spark, bad), f"{tmp_path}/out", "x.dat")
    assert np.fromfile(f"{tmp_path}/out/a/x.dat", "<i2").tolist() == [7] and os.listdir(tmp_path) == ["out"]


def test_a_failed_append_leaves_the_old_file(spark, tmp_path):
    path = make(f"{tmp_path}/a.dat", range(1000))
    fails = F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stopped")).cast("long"))
    with pytest.raises(Exception, match="stopped"):
        dat.write_dat(spark.range(100).select(F.col("id").alias("sample_idx"), F.array(fails).alias("x")), path, mode="append", first=0)
    assert np.fromfile(path, "<i2").tolist() == list(range(1000)) and os.listdir(tmp_path) == ["a.dat"]
    rows = spark.range(10).select((F.col("id") + 4).alias("sample_idx"), F.array("id").alias("x"))
    dat.write_dat(rows, path, mode="append")
    dat.write_dat(rows.limit(0), path, mode="append")
    assert np.fromfile(path, "<i2").tolist() == [*range(1000), *range(10)] and os.listdir(tmp_path) == ["a.dat"]


def test_a_stream_of_samples(spark, tmp_path):
    """Micro-batches in any cut end in the same file; a batch that is repeated changes nothing."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = [("ab"[i % 2], i // 2, [float(i), -float(i)]) for i in range(200)]
    for k, (a, b) in enumerate([(0, 31), (31, 32), (32, 150), (150, 200)]):
        recording(spark, rows[a:b]).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("session string, sample_idx long, x array<double>").option("maxFilesPerTrigger", 1).parquet(source)
        dat.stream_dat(stream, out, f"{tmp_path}/check", file="x.dat").awaitTermination()
        for s in "ab":
            own = [r[2] for r in rows[:b] if r[0] == s]
            assert np.fromfile(f"{out}/{s}/x.dat", "<i2").reshape(-1, 2).tolist() == own
    # a checkpoint that was lost: all batches once more
    stream = spark.readStream.schema("session string, sample_idx long, x array<double>").parquet(source)
    dat.stream_dat(stream, out, f"{tmp_path}/check2", file="x.dat").awaitTermination()
    assert np.fromfile(f"{out}/b/x.dat", "<i2").reshape(-1, 2).tolist() == [r[2] for r in rows if r[0] == "b"]


def test_short_files_share_a_task_and_long_ones_are_cut(spark, tmp_path):
    for k in range(100):
        make(f"{tmp_path}/s{k:03}/a.dat", range(3))
    make(f"{tmp_path}/long/a.dat", range(2500))
    df = dat.read_dat(spark, str(tmp_path), 1, frames_per_partition=1000)
    assert 4 <= df.rdd.getNumPartitions() <= 8
    assert df.count() == 2800 and df.agg(F.sum(F.get("x", F.lit(0)))).first()[0] == sum(range(2500)) + 300
    assert dat.read_dat(spark, f"{tmp_path}/s00*/a.dat", 1).select("session").distinct().count() == 10


def test_paths_and_uris(tmp_path):
    from sigspark.sources import files

    for name in ("b/x.dat", "a/x.dat", "a/y.txt", "a/c/z.dat"):
        make(f"{tmp_path}/{name}", [1, 2])
    every = [(f"{tmp_path}/{n}", 4) for n in ("a/c/z.dat", "a/x.dat", "b/x.dat")]
    for path in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}"):
        assert files.listed(path, "*.dat") == every
        assert files.listed(f"{path}/*/x.dat") == every[1:]
        assert files.listed(f"{path}/a/x.dat") == every[1:2]
        assert files.listed(f"{path}/none*") == []
        with pytest.raises(FileNotFoundError):
            files.listed(f"{path}/none")
    with files.opened(f"file://{tmp_path}/a/x.dat") as f:
        f.seek(2)
        assert f.read(2) == b"\2\0"


def test_files_of_another_file_system(spark, tmp_path, monkeypatch):
    """Ranges are read through the file system that a URI names."""
    from pyarrow import fs

    from sigspark.sources import files

    make(f"{tmp_path}/bucket/s1/a.dat", range(10))
    made = []

    def from_uri(uri):
        made.append(uri)
        return fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()), "bucket"

    monkeypatch.setattr(files, "fs", type("fs", (), {"FileSystem": type("F", (), {"from_uri": staticmethod(from_uri)}), "FileType": fs.FileType, "FileSelector": fs.FileSelector, "LocalFileSystem": fs.LocalFileSystem}))
    assert files.listed("s3://bucket/s1", "*.dat") == [("s3://bucket/s1/a.dat", 20)]
    with files.opened("s3://bucket/s1/a.dat") as f:
        assert f.size() == 20
    assert set(made) == {"s3://bucket/"}


def test_images_of_many_sizes(spark):
    """Stacks give what single images give; nulls, empty images and missing pixels stay in their rows."""
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 255, (h, 8)).astype(float) for h in (8, 4, 8, 2, 4, 1)]
    rows = [(i, None if m is None else [float(v) for v in m.reshape(-1)]) for i, m in enumerate([images[0], None, *images[1:], np.zeros((0, 8))])]
    df = spark.createDataFrame(rows, "i int, p array<double>").coalesce(1)
    for op, kernel in ((lambda d: V.demosaic(d, "p", 8), K.demosaic), (lambda d: V.repair_pixels(d, "p", 8, [1, 2, 8, 8]), lambda m: K.repair(m, [1, 2, 8, 8]))):
        got = {r.i: r.image for r in op(df.where("i <> 7")).collect()}
        assert got[1] is None
        for i, p in rows[:-1]:
            if p is not None:
                assert np.allclose(got[i], kernel(np.array(p).reshape(-1, 8)).reshape(-1))
    assert V.demosaic(df.where("i = 7"), "p", 8).first().image == []


def test_many_short_files_are_few_tasks_and_batches(spark, tmp_path):
    for k in range(300):
        make(f"{tmp_path}/s{k:03}/a.dat", range(k % 4))
    df = dat.read_dat(spark, str(tmp_path), 1)
    assert df.rdd.getNumPartitions() <= 2
    assert df.count() == sum(k % 4 for k in range(300)) and df.select("session").distinct().count() == 225
    reader = dat.DatReader({"path": str(tmp_path), "nch": "1", "layout": "long"})
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(batches) <= 2
    assert sorted({b for x in batches for b in x.column("session").to_pylist()}) == [f"s{k:03}" for k in range(300) if k % 4]


def test_events_of_many_sessions_share_files(spark, tmp_path):
    """Files are few however many sessions there are, by the operator and in the query; a null session is one."""
    import datetime

    from sigspark.plans import registry

    at = datetime.datetime(2024, 1, 1)
    rows = [(i, at, None if i == 7 else i % 300, "click", 1.0, None) for i in range(600)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    out = registry.QUERIES["event_files"](spark, str(tmp_path))
    assert len(out.inputFiles()) <= 8
    want = [(u, round(i / 1250.0, 6), f"click start {i % 16 + 1}", "click", "start", i % 16 + 1) for i, _, u, *_ in rows]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert text.read_sessions(spark, os.path.dirname(out.inputFiles()[0])).where("session IS NULL").count() == 1
