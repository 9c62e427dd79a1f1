import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.functions import kernels as K
from sigspark.operators import events as E
from sigspark.operators import ordered as O
from sigspark.operators import signals as S


def signal(spark, values, key=1):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "k long, sample_idx long, v double" if isinstance(values[0], float) else "k long, sample_idx long, v long")


@pytest.mark.parametrize("chunk", [1, 2, 3, 1 << 20])
def test_edges_at_both_ends(spark, chunk):
    df = signal(spark, [1, 1, 0, 0, 1, 0, 1, 1])
    got = {(r.phase, r.tick) for r in O.word_edges(df, ["k"], "sample_idx", "v", 1, chunk).collect()}
    assert got == {("start", 1), ("start", 5), ("start", 7), ("end", 3), ("end", 6), ("end", 9)}
    runs = O.runs(O.word_edges(df, ["k"], "sample_idx", "v", 1, chunk), ["k", "bit"]).collect()
    assert sorted((r.start_tick, r.end_tick, r.ticks) for r in runs) == [(1, 3, 2), (5, 6, 1), (7, 9, 2)]


def test_edges_of_random_words(spark):
    rng = np.random.default_rng(1)
    words = rng.integers(0, 65536, 500).tolist()
    words[3] = -1  # bit 15 set in a signed word
    got = {(r.bit, r.phase, r.tick) for r in O.word_edges(signal(spark, words), ["k"], "sample_idx", "v", 16, 64).collect()}
    want = set()
    for b in range(16):
        x = np.array([0, *((w & 65535) >> b & 1 for w in words), 0])
        want |= {(b, "start", int(i) + 1) for i in np.flatnonzero(np.diff(x) == 1)} | {(b, "end", int(i) + 1) for i in np.flatnonzero(np.diff(x) == -1)}
    assert got == want


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_running_sum(spark, chunk):
    x = np.random.default_rng(2).normal(size=100)
    got = O.running_sum(signal(spark, x.tolist()), ["k"], "sample_idx", "v", "s", chunk).orderBy("sample_idx").toPandas().s
    assert np.allclose(got, np.cumsum(x))


def test_interval_and_refractory(spark):
    df = spark.createDataFrame([(1, t) for t in (1.0, 6.0, 8.0, 12.0, 30.0)], "k long, t double")
    assert [r.t for r in E.interval_filter(df, ["k"], "t", 3.0).orderBy("t").collect()] == [6.0, 12.0, 30.0]
    assert [r.t for r in O.greedy_refractory(df, ["k"], ["t"], "t", 5.0).orderBy("t").collect()] == [1.0, 6.0, 12.0, 30.0]


def test_event_text_round_trip(spark, tmp_path):
    from sigspark.sources import text

    df = spark.createDataFrame([(0.5, "DigitIn start 3"), (1.25, "free text 7"), (2.0, "StimOn end 12")], "time double, description string")
    text.write_events(df, str(tmp_path / "a.evt"))
    got = text.read_events(spark, str(tmp_path / "a.evt")).orderBy("time").collect()
    assert [(r.time, r.description, r.kind, r.phase, r.channel) for r in got] == [(0.5, "DigitIn start 3", "DigitIn", "start", 3), (1.25, "free text 7", None, None, None), (2.0, "StimOn end 12", "StimOn", "end", 12)]
    with pytest.raises(Exception, match="(?i)exist"):
        text.write_events(df, str(tmp_path / "a.evt"))


def test_detect_only_keeps_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "us long")
    assert sorted(r.us for r in E.detect_only(left, spark.createDataFrame([(3,), (3,)], "us long"), ["us"]).collect()) == [1, 2, 2]


def naive(b, a, x):
    y = []
    for n in range(len(x)):
        y.append(sum(b[k] * x[n - k] for k in range(len(b)) if n >= k) - sum(a[k] * y[n - k] for k in range(1, len(a)) if n >= k))
    return np.array(y)


def test_filters(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=300)
    b, a = K.butter2(50, 1250, "low")
    assert np.allclose(K.iir(b, a, x)[0], naive(b, a, x))
    assert abs(b.sum() / a.sum() - 1) < 1e-12 and abs(K.butter2(50, 1250, "high")[0].sum()) < 1e-12
    w = np.exp(-2j * np.pi * 50 / 1250 * np.arange(3))
    assert abs(abs((b @ w) / (a @ w)) - np.sqrt(0.5)) < 1e-9
    y = K.zero_phase(b, a, x)
    assert np.allclose(K.zero_phase(b, a, x[::-1])[::-1][100:200], y[100:200], atol=1e-3)
    assert np.allclose(K.zero_phase(*K.butter2(0.5, 1250, "high"), np.full(200, 7.0)), 0, atol=1e-9)
    got = S.zero_phase_filter(signal(spark, x.tolist()), ["k"], "sample_idx", "v", 50, 1250, "low").orderBy("sample_idx").toPandas().y
    assert np.allclose(got, y)
    got = O.iir_filter(signal(spark, x.tolist()), ["k"], ["sample_idx"], "v", b.tolist(), a.tolist()).orderBy("sample_idx").toPandas().y
    assert np.allclose(got, naive(b, a, x))


@pytest.mark.parametrize(("p", "q"), [(2, 5), (3, 10), (5, 2), (1, 1), (2, 25)])
def test_resample(p, q):
    rng = np.random.default_rng(4)
    x = rng.normal(size=97)
    taps = K.resample_taps(p, q)
    up = np.zeros(len(x) * p)
    up[::p] = x
    full = np.convolve(up, taps)[len(taps) // 2 :]
    want = full[::q][: -(-len(x) * p // q)] if p != q else x
    assert np.allclose(K.resample(x, p, q), want)
    flat = K.resample(np.full(2000, 3.0), p, q)
    assert np.allclose(flat[len(flat) // 3 : len(flat) // 2], 3.0, atol=0.02)


def test_resample_as_relation(spark):
    x = np.random.default_rng(5).normal(size=83)
    taps = [0.1, 0.3, 0.5, 0.8, 0.5, 0.3, 0.1]
    got = S.resample_by_join(signal(spark, x.tolist()), ["k"], "sample_idx", "v", 2, 5, taps).orderBy("sample_idx").toPandas().y
    assert np.allclose(got, K.resample(x, 2, 5, np.array(taps)))


def test_orientation():
    n, fs = 400, 100.0
    still = K.orientation(np.tile([0, 0, 9.8], (n, 1)), np.zeros((n, 3)), None, fs)
    assert np.allclose(still, [1, 0, 0, 0])
    turn = K.orientation(np.zeros((100, 3)), np.tile([0, 0, np.pi / 2], (100, 1)), None, fs)
    assert np.allclose(turn[-1], [np.cos(np.pi / 4), 0, 0, np.sin(np.pi / 4)])
    tilted = K.orientation(np.tile([0, 9.8 * np.sin(0.5), 9.8 * np.cos(0.5)], (n, 1)), np.zeros((n, 3)), None, fs)
    r = K.matrix_of(tilted[-1])
    assert np.allclose(r @ r.T, np.eye(3)) and np.allclose(r @ [0, np.sin(0.5), np.cos(0.5)], [0, 0, 1], atol=1e-3)
    first = K.orientation(np.zeros((60, 3)), np.tile([0, 0.3, 1], (60, 1)), None, fs)
    assert np.allclose(K.orientation(np.zeros((40, 3)), np.tile([0, 0.3, 1], (40, 1)), None, fs, start=first[-1])[-1], K.orientation(np.zeros((100, 3)), np.tile([0, 0.3, 1], (100, 1)), None, fs)[-1])


def test_dsp_modes(spark):
    df = signal(spark, [0.0, 10.0, 10.0, 0.0])
    a, b = ([1.0, 0.0], [1.0, 0.0]), ([0.5, 0.0], [1.0, 0.0])
    fired = {m: [r.trigger for r in S.dsp_mode(df, ["k"], "sample_idx", "v", m, a, b, 6.0).orderBy("sample_idx").collect()] for m in ("disabled", "single", "double", "cascade", "gated")}
    assert fired == {"disabled": [False] * 4, "single": [False, True, True, False], "double": [False, True, True, False], "cascade": [False] * 4, "gated": [False] * 4}
    assert S.dsp_mode(df, ["k"], "sample_idx", "v", "random", a, b, 1.0).where("trigger").count() == 4


def test_median_and_gain(spark):
    df = spark.createDataFrame([(1, float(i), 0.0, 3.0) for i in (1, 2, 9)], "k long, x double, y double, z double")
    assert sorted(r.x for r in S.remove_median(df, ["k"], ["x"]).collect()) == [-1.0, 0.0, 7.0]
    out = S.calibrate_gain(df, ["k"], ["x", "y", "z"]).toPandas()
    assert np.isclose(np.median(np.sqrt(out.x**2 + out.y**2 + out.z**2)), 9.81)


@pytest.mark.parametrize(("start", "until", "want"), [(0, float("inf"), (0, 99)), (5, 10, (5, 10)), (-10, 0, (90, 99)), (-200, 3, (0, 3)), (2, 500, (2, 99)), (1.6, 2.4, (2, 2))])
def test_range(start, until, want):
    assert S.resolve_range(100, start, until) == want


def test_bits_and_samples(spark):
    from sigspark.functions import columns as C

    df = spark.createDataFrame([(-32768,), (-1,), (0,), (1,), (32767,)], "w long")
    rows = df.select("w", C.bit_list("w", 16).alias("b"), C.signed16("w").alias("s"), C.audio_sample(C.unsigned16("w")).alias("a"), C.audio_sample(C.unsigned16("w"), True).alias("c")).collect()
    for r in rows:
        u = r.w & 65535
        assert sum(v << i for i, v in enumerate(r.b)) == u and r.s == r.w and r.a == u - 32768 and r.c == (u + 32768) % 65536
    sat = spark.createDataFrame([(40000.0,), (-40000.0,), (2.5,), (-2.5,)], "x double").select(C.saturate_int16("x").alias("y"))
    assert [r.y for r in sat.collect()] == [32767, -32768, 3, -3]
    assert spark.range(1).select(C.utf16_string(F.lit("")).alias("s")).first().s.length == 0


def test_pitch_shift():
    t = np.arange(16_000) / 8000
    y = K.pitch_shift(np.sin(2 * np.pi * 800 * t), -12)
    assert len(y) == len(t)
    peak = np.abs(np.fft.rfft(y[4000:12_000] * np.hanning(8000))).argmax()
    assert abs(peak - 400) <= 3


def test_bands_and_hilbert():
    x = np.sin(2 * np.pi * 8 * np.arange(5000) / 1250)
    inside = outside = x
    for b, a in K.band2(4, 12, 1250):
        inside = K.iir(b, a, inside)[0]
    for b, a in K.band2(100, 200, 1250):
        outside = K.iir(b, a, outside)[0]
    assert np.abs(inside[2500:]).max() > 0.7 and np.abs(outside[2500:]).max() < 0.02
    tone = np.cos(2 * np.pi * 0.2 * np.arange(400))
    turned = np.convolve(tone, K.hilbert_taps(), "same")
    assert np.allclose(turned[50:350], np.sin(2 * np.pi * 0.2 * np.arange(400))[50:350], atol=0.02)


def channels(spark, lengths, seed=6):
    rng = np.random.default_rng(seed)
    data = {k: rng.normal(size=n).cumsum() for k, n in lengths.items()}
    rows = [(k, i, float(v)) for k, x in data.items() for i, v in enumerate(x)]
    rng.shuffle(rows)
    return data, spark.createDataFrame([(r[0], int(r[1]), float(r[2])) for r in rows], "k string, sample_idx long, v double")


LENGTHS = {"a": 1000, "b": 64, "c": 127, "d": 129, "e": 5, "f": 1, None: 200, "g": 2}


@pytest.mark.parametrize(("kind", "cutoff"), [("high", 0.5), ("low", 50), ("high", 100)])
def test_zero_phase_by_chunks(spark, kind, cutoff):
    data, df = channels(spark, LENGTHS)
    got = S.zero_phase_filter(df, ["k"], "sample_idx", "v", cutoff, 1250, kind, chunk=64).toPandas()
    assert len(got) == sum(LENGTHS.values())
    b, a = K.butter2(cutoff, 1250, kind)
    for k, x in data.items():
        own = got[got.k.isna() if k is None else got.k == k].sort_values("sample_idx")
        assert own.sample_idx.tolist() == list(range(len(x)))
        assert np.allclose(own.y, K.zero_phase(b, a, x), atol=1e-9, rtol=1e-9)


@pytest.mark.parametrize(("p", "q"), [(2, 25), (1250, 20000), (3, 2), (1, 1), (3, 10)])
def test_resample_by_chunks(spark, p, q):
    data, df = channels(spark, LENGTHS)
    got = S.resample(df, ["k"], "sample_idx", "v", p, q, chunk=64).toPandas()
    for k, x in data.items():
        own = got[got.k.isna() if k is None else got.k == k].sort_values("sample_idx")
        want = K.resample(x, p, q)
        assert own.sample_idx.tolist() == list(range(len(want)))
        assert np.allclose(own.y, want, atol=1e-9, rtol=1e-9)


@pytest.mark.parametrize("first", [7, 128, 130, 10_000])
def test_channels_that_start_anywhere(spark, first):
    data, df = channels(spark, LENGTHS)
    moved = df.withColumn("sample_idx", F.col("sample_idx") + first)
    for cutoff, kind in ((0.5, "high"), (100, "low")):
        got = S.zero_phase_filter(moved, ["k"], "sample_idx", "v", cutoff, 1250, kind, chunk=64).toPandas()
        b, a = K.butter2(cutoff, 1250, kind)
        for k, x in data.items():
            own = got[got.k.isna() if k is None else got.k == k].sort_values("sample_idx")
            assert own.sample_idx.tolist() == list(range(first, first + len(x)))
            assert np.allclose(own.y, K.zero_phase(b, a, x), atol=1e-9, rtol=1e-9)
    for p, q in ((2, 25), (3, 2)):
        got = S.resample(moved, ["k"], "sample_idx", "v", p, q, chunk=64).toPandas()
        for k, x in data.items():
            own = got[got.k.isna() if k is None else got.k == k].sort_values("sample_idx")
            want = K.resample(x, p, q)
            assert own.sample_idx.tolist() == list(range(first * p // q, first * p // q + len(want)))
            assert np.allclose(own.y, want, atol=1e-9, rtol=1e-9)


@pytest.mark.parametrize("first", [0, 130])
def test_rows_of_all_channels(spark, first):
    """An array with an element for each channel gives what the channels give by themselves."""
    rng = np.random.default_rng(4)
    rows = [(k, first + i, rng.normal(size=3).tolist()) for k, n in (("a", 700), (None, 90), ("b", 1)) for i in range(n)]
    rows[5][2][1] = None
    df = spark.createDataFrame(rows, "k string, sample_idx long, x array<double>").repartition(3)
    each = df.select("k", "sample_idx", F.posexplode("x").alias("c", "v"))
    for of in (lambda d, keys, v: S.resample(d, keys, "sample_idx", v, 2, 5, chunk=64), lambda d, keys, v: S.zero_phase_filter(d, keys, "sample_idx", v, 100, 1250, chunk=64)):
        got = of(df, ["k"], "x").select("k", "sample_idx", F.posexplode("y").alias("c", "y"))
        want = of(each, ["k", "c"], "v")
        a, b = ({(r.k, r.sample_idx, r.c): r.y for r in d.collect()} for d in (got, want))
        assert a.keys() == b.keys() and np.allclose([a[k] for k in a], [b[k] for k in a], atol=1e-12)
    with pytest.raises(Exception, match="same channels"):
        S.resample(df.withColumn("x", F.slice("x", 1, F.when(F.col("sample_idx") == first + 3, 2).otherwise(3))), ["k"], "sample_idx", "x", 2, 5).count()


def test_a_null_sample_counts_as_zero(spark):
    data, df = channels(spark, {"a": 300, "b": 40})
    holes = df.withColumn("v", F.when(F.col("sample_idx") % 17 != 3, F.col("v")))
    zeros = {k: np.where(np.arange(len(x)) % 17 != 3, x, 0.0) for k, x in data.items()}
    b, a = K.butter2(100, 1250, "low")
    got = S.zero_phase_filter(holes, ["k"], "sample_idx", "v", 100, 1250, "low", chunk=64).orderBy("k", "sample_idx").toPandas()
    assert np.allclose(got.y, np.concatenate([K.zero_phase(b, a, zeros[k]) for k in "ab"]))
    got = S.resample(holes, ["k"], "sample_idx", "v", 1, 3, chunk=64).orderBy("k", "sample_idx").toPandas()
    assert np.allclose(got.y, np.concatenate([K.resample(zeros[k], 1, 3) for k in "ab"]))


def test_groups_over_many_batches(spark):
    """Chunks that are longer than an Arrow batch, and batches that hold many chunks."""
    data, df = channels(spark, {f"k{i}": n for i, n in enumerate([3000, 5, 2999, 1, 700, 700])})
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
        got = S.zero_phase_filter(df, ["k"], "sample_idx", "v", 50, 1250, chunk=1000).orderBy("k", "sample_idx").toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert np.allclose(got.y, np.concatenate([K.zero_phase(*K.butter2(50, 1250, "high"), data[k]) for k in sorted(data)]), atol=1e-9)


def test_signals_without_keys_and_with_gaps(spark):
    data, df = channels(spark, {"a": 300})
    got = S.zero_phase_filter(df, [], "sample_idx", "v", 5, 1250, chunk=64).orderBy("sample_idx").toPandas().y
    assert np.allclose(got, K.zero_phase(*K.butter2(5, 1250, "high"), data["a"]))
    got = S.resample(df, [], "sample_idx", "v", 1, 4, chunk=64).orderBy("sample_idx").toPandas().y
    assert np.allclose(got, K.resample(data["a"], 1, 4))
    assert S.zero_phase_filter(df.limit(0), ["k"], "sample_idx", "v", 5, 1250).count() == 0
    with pytest.raises(Exception, match="not numbered"):
        S.resample(df.where("sample_idx <> 7"), ["k"], "sample_idx", "v", 1, 4).count()


def test_no_row_is_lost_to_a_null(spark):
    """Rows with null keys are a group of their own; null values stay, or are left out where a docstring says so."""
    rows = [("a", 0, 1.0), ("a", 1, None), (None, 0, 4.0), (None, 1, 6.0), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    at = lambda out, c: sorted(((r.k, r.i, r[c]) for r in out.collect()), key=str)
    want = lambda *v: sorted(zip([r[0] for r in rows], [r[1] for r in rows], v, strict=True), key=str)
    assert at(S.remove_median(df, ["k"], ["v"]), "v") == want(0.0, None, -1.0, 1.0, None)
    assert at(S.remove_median(df, [], ["v"]), "v") == want(-3.0, None, 0.0, 2.0, None)
    assert at(S.with_statistic(df, ["k"], n=F.count("v")), "n") == want(1, 1, 2, 2, 2)
    assert at(S.equalise_histogram(df, ["k"], "v"), "equalised") == want(1, None, 0, 255, None)
    assert at(O.running_sum(df, ["k"], "i", "v", "s", 2), "s") == want(1.0, 1.0, 4.0, 10.0, 10.0)
    assert at(O.fir(df, ["k"], "i", "v", [1.0, 0.5], chunk=2), "y") == want(1.0, 0.5, 4.0, 8.0, 3.0)
    assert at(O.moving_average(df, ["k"], "i", "v", 2, chunk=2), "y") == want(1.0, 1.0, 4.0, 5.0, 6.0)
    assert at(O.iir_filter(df, ["k"], ["i"], "v", [1.0], [1.0, -0.5]), "y") == want(1.0, 0.5, 4.0, 8.0, 4.0)
    assert at(S.zip_signals(df, df.select("k", "i", F.col("v").alias("w")), ["k"], "i"), "w") == want(1.0, None, 4.0, 6.0, None)
    assert at(S.resample_by_join(df, ["k"], "i", "v", 1, 1, [1.0]), "y") == want(1.0, None, 4.0, 6.0, None)
    assert at(S.attach_frames(df, df.select("k", F.col("i").alias("frame_idx"), F.col("v").alias("w")), ["k"], "i", 1), "w") == want(1.0, None, 4.0, 6.0, None)
    assert at(O.first_difference(df, ["k"], ["i"], "v"), "step") == want(1.0, None, 4.0, 2.0, None)
    assert at(O.every_other(df, ["k"], ["i"]), "v") == [("a", 0, 1.0), (None, 0, 4.0), (None, 2, None)]
    assert at(O.greedy_refractory(df, ["k"], ["i"], "v", 1.0), "v") == [("a", 0, 1.0), (None, 0, 4.0), (None, 1, 6.0)]
    assert at(E.interval_filter(df, ["k"], "v", 0.5), "v") == [("a", 0, 1.0), (None, 0, 4.0), (None, 1, 6.0)]
    words = df.withColumn("v", F.col("v").cast("long"))
    edges = {(r.k, r.phase, r.tick) for r in O.threshold_edges(words, ["k"], "i", "v", 3).collect()}
    assert edges == {(None, "start", 1), (None, "end", 3)}


@pytest.mark.parametrize("chunk", [1, 3, 64, 1 << 20])
def test_short_filters_by_chunks(spark, chunk):
    x = np.random.default_rng(9).normal(size=200)
    taps = [0.4, -0.3, 0.2, 0.1, 0.05]
    df = signal(spark, x.tolist())
    assert np.allclose(O.fir(df, ["k"], "sample_idx", "v", taps, chunk=chunk).orderBy("sample_idx").toPandas().y, np.convolve(x, taps)[:200])
    got = O.moving_average(df, ["k"], "sample_idx", "v", 7, chunk=chunk).orderBy("sample_idx").toPandas().y
    assert np.allclose(got, [x[max(0, i - 6) : i + 1].mean() for i in range(200)])


def test_events_not_before_the_last_of_all(spark):
    events = spark.createDataFrame([(1.0,), (5.0,), (7.0,)], "t double")
    assert sorted(r.t for r in E.after_last(events, spark.createDataFrame([(2.0,), (5.0,)], "t double"), "t").collect()) == [5.0, 7.0]
    assert E.after_last(events, events.limit(0), "t").count() == 3


def test_hilbert_modes(spark):
    """The envelope of a tone is its size, where the tone itself falls below the level twice a period."""
    t = np.arange(500)
    df = signal(spark, (2.0 * np.cos(2 * np.pi * 0.2 * t)).tolist())
    same = ([1.0, 0.0], [1.0, 0.0])
    one = S.dsp_mode(df, ["k"], "sample_idx", "v", "single_hilbert", same, same, 1.8).orderBy("sample_idx").toPandas()
    assert np.allclose(one.dsp1[100:], 2.0, atol=0.1) and one.trigger[100:].all() and (one.dsp2 == 0).all()
    plain = S.dsp_mode(df, ["k"], "sample_idx", "v", "single", same, same, 1.8).toPandas()
    assert 0 < plain.trigger.sum() < 200
    both = S.dsp_mode(df, ["k"], "sample_idx", "v", "double_hilbert", ([0.1, 0.0], [1.0, 0.0]), same, 1.8).orderBy("sample_idx").toPandas()
    assert (both.dsp1 < 1).all() and both.trigger[100:].all()


def turning(n, fs, seed=3):
    """Nine axes of a device that turns about changing axes, its true quaternions and a gyroscope offset."""
    rng = np.random.default_rng(seed)
    at = np.arange(n) / fs
    rate = np.stack([0.6 * np.sin(2 * np.pi * f * at + p) for f, p in ((0.11, 0.3), (0.17, 1.0), (0.07, 2.0))], 1)
    q, true = np.array([1.0, 0, 0, 0]), []
    for w in rate:
        q = K._turned(q, w / fs)
        true.append(q)
    down, north = np.array([0, 0, 9.81]), 50 * np.array([np.cos(0.9), 0, np.sin(0.9)])
    acc = np.stack([K.matrix_of(t).T @ down for t in true]) + rng.normal(0, 0.02, (n, 3))
    mag = np.stack([K.matrix_of(t).T @ north for t in true]) + rng.normal(0, 0.3, (n, 3))
    offset = np.array([0.02, -0.015, 0.01])
    return acc, rate + offset + rng.normal(0, 0.005, (n, 3)), mag, np.array(true), offset


def apart(p, q):
    """Degrees between quaternions."""
    return np.degrees(2 * np.arccos(np.clip(np.abs((p * q).sum(1)), 0, 1)))


def test_kalman_orientation():
    acc, gyr, mag, true, offset = turning(3000, 100.0)
    f = K.Ahrs(100.0)
    got = np.array([f.step(*row) for row in zip(acc, gyr, mag, strict=True)])
    assert np.median(apart(got, true)) < 1 and apart(got, true)[200:].max() < 3
    assert np.abs(f.offset - offset).max() < 0.01
    # the simpler filter ends nearby
    simple = K.orientation(acc, gyr, mag, 100.0)
    assert np.median(apart(got, simple)[500:]) < 5


def test_kalman_survives_a_magnet_and_still_air():
    acc, gyr, mag, true, _ = turning(1500, 100.0)
    mag[700:800] += 500.0
    f = K.Ahrs(100.0)
    got = np.array([f.step(*row) for row in zip(acc, gyr, mag, strict=True)])
    assert apart(got, true)[1200:].max() < 5
    f = K.Ahrs(100.0)
    assert np.allclose(f.step(np.array([0, 0, 9.81]), np.zeros(3), np.array([30.0, 0, 40.0])), [1, 0, 0, 0], atol=1e-6)
    assert np.isfinite(K.Ahrs(100.0).step(np.zeros(3), np.zeros(3), np.zeros(3))).all()


def test_quaternion_of_a_matrix():
    rng = np.random.default_rng(1)
    for q in [*rng.normal(size=(20, 4)), *np.eye(4)]:
        q = q / np.linalg.norm(q)
        assert np.isclose(abs(K.quaternion_of(K.matrix_of(q)) @ q), 1)


def test_orientation_streams_by_key(spark):
    acc, gyr, mag, *_ = turning(300, 100.0)
    names = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]
    rows = [(k, i, *map(float, np.concatenate((acc[i], gyr[i], mag[i])))) for k in (1, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, i long, " + ", ".join(f"{n} double" for n in names))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        for method, want in (("kalman", None), ("complementary", K.orientation(acc, gyr, mag, 100.0))):
            if want is None:
                f = K.Ahrs(100.0)
                want = np.array([f.step(*row) for row in zip(acc, gyr, mag, strict=True)])
            got = S.fuse_orientation(df, ["k"], "i", 100.0, method).orderBy("k", "i").toPandas()
            assert np.allclose(np.stack(got.q), np.concatenate((want, want)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError, match="method"):
        S.fuse_orientation(df, ["k"], "i", 100.0, "none")


AXES = [f"{s}_{a}" for s in ("acc", "gyr", "mag") for a in "xyz"]


def test_orientation_by_chunks_is_near_the_sequential_one(spark):
    """The bounds that the docstring states."""
    acc, gyr, mag, *_ = turning(12_000, 100.0)
    rows = [("a", i, *map(float, np.concatenate((acc[i], gyr[i], mag[i])))) for i in range(12_000)]
    df = spark.createDataFrame(rows, "k string, i long, " + ", ".join(f"{n} double" for n in AXES))
    whole = np.stack(S.fuse_orientation(df, ["k"], "i", 100.0).orderBy("i").toPandas().q)
    cut = S.fuse_orientation(df, ["k"], "i", 100.0, chunk=3000, warm=3000)
    assert "_chunk" in cut._jdf.queryExecution().executedPlan().toString()
    got = cut.orderBy("i").toPandas()
    assert got.i.tolist() == list(range(12_000))
    away = apart(np.stack(got.q), whole)
    assert away.max() < 0.1 and np.median(away) < 0.002 and away[:3000].max() < 1e-4


@pytest.mark.parametrize("method", ["kalman", "complementary"])
def test_a_missing_axis_keeps_the_orientation(spark, method):
    acc, gyr, mag, *_ = turning(120, 100.0)
    rows = [[k, i, *map(float, np.concatenate((acc[i], gyr[i], mag[i])))] for k in ("a", None) for i in range(120)]
    for r in rows:
        if r[1] in (0, 1, 40, 41, 80):
            r[2 + r[1] % 9] = None
    df = spark.createDataFrame(rows, "k string, i long, " + ", ".join(f"{n} double" for n in AXES))
    for chunk in (None, 200):
        got = {(r.k, r.i): r.q for r in S.fuse_orientation(df, ["k"], "i", 100.0, method, chunk=chunk, warm=10).collect()}
        assert len(got) == 240
        for k in ("a", None):
            assert got[k, 0] is None and got[k, 1] is None and got[k, 2] is not None
            assert got[k, 40] == got[k, 39] and got[k, 41] == got[k, 39] and got[k, 80] == got[k, 79]
            good = [i for i in range(120) if i not in (0, 1, 40, 41, 80)]
            if method == "kalman":
                f = K.Ahrs(100.0)
                want = [f.step(acc[i], gyr[i], mag[i]) for i in good]
            else:
                want = K.orientation(acc[good], gyr[good], mag[good], 100.0)
            assert np.allclose([got[k, i] for i in good], want, atol=1e-12)


@pytest.mark.parametrize(("semitones", "lengths"), [(-4.0, {"a": 30_000, "b": 700, "c": 1, "d": 4096}), (7.0, {"a": 20_000, "b": 513}), (0.0, {"a": 5000}), (-24.0, {"a": 9000})])
def test_pitch_by_chunks(spark, semitones, lengths):
    """Chunks of a few frames give what the whole channel gives; a channel may start anywhere."""
    rng = np.random.default_rng(2)
    data = {k: np.sin(np.arange(n) * 0.07) * 100 + rng.normal(size=n) for k, n in lengths.items()}
    first = {k: 1000 * i for i, k in enumerate(data)}
    df = spark.createDataFrame([(k, first[k] + i, float(v)) for k, x in data.items() for i, v in enumerate(x)], "k string, i long, v double").repartition(4)
    got = S.pitch_shift(df, ["k"], "i", "v", semitones, steps=8).toPandas()
    for k, x in data.items():
        own = got[got.k == k].sort_values("i")
        assert own.i.tolist() == list(range(first[k], first[k] + len(x)))
        assert np.allclose(own.y, K.pitch_shift(x, semitones), atol=1e-6)
    assert S.pitch_shift(df.limit(0), ["k"], "i", "v", semitones).count() == 0


@pytest.mark.parametrize("cutoff", [3, 200])
def test_causal_filter_by_chunks(spark, cutoff):
    data, df = channels(spark, LENGTHS)
    b, a = K.butter2(cutoff, 1250, "high")
    moved = df.withColumn("sample_idx", F.col("sample_idx") + 70)
    out = O.iir_filter(moved, ["k"], ["sample_idx"], "v", b.tolist(), a.tolist(), dense=True, chunk=64)
    assert "_chunk" in out._jdf.queryExecution().executedPlan().toString()
    got = out.toPandas()
    for k, x in data.items():
        own = got[got.k.isna() if k is None else got.k == k].sort_values("sample_idx")
        assert np.allclose(own.y, K.iir(b, a, x)[0], atol=1e-9) and np.allclose(own.v, x)
    # an integrator never forgets: its state is carried
    out = O.iir_filter(df, ["k"], ["sample_idx"], "v", [1.0], [1.0, -1.0], dense=True, chunk=64).toPandas()
    assert np.allclose(out[out.k == "a"].sort_values("sample_idx").y, np.cumsum(data["a"]))


def test_calibrate_is_both_at_once(spark):
    rng = np.random.default_rng(3)
    rows = [(k, *map(float, rng.normal(size=4))) for k in ("a", None) for _ in range(31)]
    df = spark.createDataFrame(rows, "k string, x double, y double, z double, w double")
    same = lambda d: np.array(sorted(tuple(r)[1:] for r in d.collect()))
    want = S.remove_median(S.calibrate_gain(df, ["k"], ["x", "y", "z"]), ["k"], ["w"])
    assert np.allclose(same(S.calibrate(df, ["k"], ["x", "y", "z"], ["w"])), same(want))
