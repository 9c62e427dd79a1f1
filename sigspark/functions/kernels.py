"""Numeric kernels (numpy): filter design, zero-phase filtering, resampling, orientation, frames."""

from __future__ import annotations

import functools

import numpy as np


def butter2(cutoff: float, fs: float, kind: str = "low") -> tuple[np.ndarray, np.ndarray]:
    """Second-order Butterworth by the bilinear transform; kind is low or high."""
    if not 0 < cutoff < fs / 2:
        raise ValueError("the cutoff must lie between 0 and half the rate")
    k = np.tan(np.pi * cutoff / fs)
    scale = 1 / (1 + np.sqrt(2) * k + k * k)
    b = np.array([k * k, 2 * k * k, k * k] if kind == "low" else [1.0, -2.0, 1.0]) * scale
    return b, np.array([1.0, 2 * (k * k - 1) * scale, (1 - np.sqrt(2) * k + k * k) * scale])


def band2(low: float, high: float, fs: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """A band as a high-pass and a low-pass section in cascade."""
    return [butter2(low, fs, "high"), butter2(high, fs, "low")]


def _same_length(b: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = max(len(a), len(b))
    return np.pad(np.asarray(b, float), (0, n - len(b))) / a[0], np.pad(np.asarray(a, float), (0, n - len(a))) / a[0]


def state_matrix(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """What one sample of zero input does to the state of the transposed direct form."""
    _, a = _same_length(b, a)
    out = np.zeros((len(a) - 1, len(a) - 1))
    out[:, 0] = -a[1:]
    out[:-1, 1:] = np.eye(len(a) - 2)
    return out


def state_after(b: np.ndarray, a: np.ndarray, state: np.ndarray, n: int) -> np.ndarray:
    """The state after n samples of zero input.

    The poles of a filter far below its rate nearly coincide, so the power is taken in extended precision.
    """
    return (np.linalg.matrix_power(state_matrix(b, a).astype(np.longdouble), n) @ state.astype(np.longdouble)).astype(float)


def steady_state(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """State of the transposed direct form that a constant input of 1 holds."""
    step = state_matrix(b, a)
    b, a = _same_length(b, a)
    return np.linalg.solve(np.eye(len(step)) - step, b[1:] - a[1:] * b[0])


def _step_by_step(b: np.ndarray, a: np.ndarray, x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output, and the state after each sample, of the transposed direct form."""
    n, z = len(b), [*z.tolist(), 0.0]
    bs, as_ = b.tolist(), a.tolist()
    y, states = np.empty(len(x)), np.empty((len(x), n - 1))
    for i, v in enumerate(x.tolist()):
        out = bs[0] * v + z[0]
        for k in range(1, n):
            z[k - 1] = bs[k] * v - as_[k] * out + z[k]
        y[i], states[i] = out, z[: n - 1]
    return y, states


@functools.lru_cache(maxsize=16)
def _block_matrices(b: tuple[float, ...], a: tuple[float, ...], block: int) -> tuple[np.ndarray, ...]:
    """For a block: response to its samples, output and last state that a state at its start adds, state that its samples add."""
    n, b, a = len(b), np.array(b), np.array(a)
    pulse, after = _step_by_step(b, a, np.eye(1, block)[0], np.zeros(n - 1))
    free = [_step_by_step(b, a, np.zeros(block), unit) for unit in np.eye(n - 1)]
    lag = np.subtract.outer(np.arange(block), np.arange(block))
    return np.where(lag >= 0, pulse[np.maximum(lag, 0)], 0.0), np.stack([f[0] for f in free]), np.stack([f[1][-1] for f in free], 1), after[::-1]


def iir(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray | None = None, block: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Causal filter; returns the output and the state to go on with.

    Blocks of samples are filtered from a zero state by one matrix product; the
    states at their starts follow one another, and their part is added.
    """
    b, a = _same_length(b, a)
    n = len(b)
    x = np.asarray(x, float)
    z = np.zeros(n - 1) if state is None else np.asarray(state, float)
    y, whole = np.empty(len(x)), len(x) // block
    if whole and n > 1:
        response, free, gain, after = _block_matrices(tuple(b.tolist()), tuple(a.tolist()), block)
        parts = x[: whole * block].reshape(whole, block)
        into = parts @ after
        starts = np.empty((whole, n - 1))
        for k in range(whole):
            starts[k] = z
            z = gain @ z + into[k]
        y[: whole * block] = (parts @ response.T + starts @ free).reshape(-1)
    else:
        whole = 0
    tail, states = _step_by_step(b, a, x[whole * block :], z)
    y[whole * block :] = tail
    return y, (states[-1] if len(states) else z)


def edge_length(b: np.ndarray, a: np.ndarray) -> int:
    """Samples that a signal is prolonged by at each end."""
    return 3 * (max(len(a), len(b)) - 1)


def zero_phase(b: np.ndarray, a: np.ndarray, x: np.ndarray, pad: int | None = None) -> np.ndarray:
    """Forward and backward filtering with odd reflection at both ends and steady-state start.

    pad defaults to 3 * (order); a signal not longer than that is padded by what it has.
    """
    x = np.asarray(x, float)
    if len(x) < 2:
        return x.copy()
    pad = edge_length(b, a) if pad is None else pad
    pad = min(pad, len(x) - 1)
    wide = np.concatenate((2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]))
    zi = steady_state(b, a)
    forward, _ = iir(b, a, wide, zi * wide[0])
    back, _ = iir(b, a, forward[::-1], zi * forward[-1])
    return back[::-1][pad : pad + len(x)]


def resample_taps(p: int, q: int, half: int = 10, beta: float = 5.0) -> np.ndarray:
    """Windowed-sinc low-pass for a p/q change of rate: 2 * half * max(p, q) + 1 taps, gain p."""
    big = max(p, q)
    t = np.arange(-half * big, half * big + 1)
    return np.sinc(t / big) / big * np.kaiser(len(t), beta) * p


def resample(x: np.ndarray, p: int, q: int, taps: np.ndarray | None = None) -> np.ndarray:
    """Polyphase change of rate by p/q with zeros beyond the ends; ceil(len * p / q) samples."""
    g = np.gcd(p, q)
    p, q = p // g, q // g
    x = np.asarray(x, float)
    if p == q:
        return x.copy()
    taps = resample_taps(p, q) if taps is None else np.asarray(taps, float)
    return resample_part(x, 0, p, q, taps, 0, -(-len(x) * p // q))


def resample_part(x: np.ndarray, first: int, p: int, q: int, taps: np.ndarray, start: int, end: int) -> np.ndarray:
    """Output samples start..end - 1 of a change of rate by p/q, of a signal of which x begins at sample ``first``; zeros beyond x.

    x may have a column for each channel.
    """
    out = np.zeros((end - start, *x.shape[1:]))
    at = np.arange(start, end) * q + len(taps) // 2  # place in the upsampled signal, delay of the filter added
    for k in range(-(-len(taps) // p)):
        j = at % p + k * p
        i = (at - j) // p - first
        good = (j < len(taps)) & (i >= 0) & (i < len(x))
        out[good] += (taps[j[good]] * x[i[good]].T).T
    return out


def hilbert_taps(half: int = 15) -> np.ndarray:
    """Windowed Hilbert transformer of 2 * half + 1 taps."""
    n = np.arange(-half, half + 1)
    ideal = np.where(n % 2 == 0, 0.0, 2 / (np.pi * np.where(n == 0, 1, n)))
    return ideal * np.hamming(len(n))


def orientation(acc: np.ndarray, gyr: np.ndarray, mag: np.ndarray | None, fs: float, gain: float = 0.1, start: np.ndarray | None = None) -> np.ndarray:
    """Unit quaternions (w, x, y, z) of a complementary filter: gyroscope integration, pulled towards gravity and north.

    ``start`` continues from an earlier quaternion.
    """
    q = np.array([1.0, 0, 0, 0]) if start is None else np.asarray(start, float).copy()
    out = np.empty((len(acc), 4))
    for i in range(len(acc)):
        w, x, y, z = q
        rate = np.asarray(gyr[i], float).copy()
        a = np.asarray(acc[i], float)
        if (n := np.linalg.norm(a)) > 0:
            up = np.array([2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)])
            rate += gain * fs * np.cross(a / n, up) * 0.5
        if mag is not None and (n := np.linalg.norm(mag[i])) > 0:
            m = np.asarray(mag[i], float) / n
            r = matrix_of(q)
            h = r @ m
            north = r.T @ np.array([np.hypot(h[0], h[1]), 0, h[2]])
            rate += gain * fs * np.cross(m, north) * 0.25
        turn = rate / fs
        angle = np.linalg.norm(turn)
        d = np.array([1.0, *(turn / 2)]) if angle < 1e-12 else np.concatenate(([np.cos(angle / 2)], np.sin(angle / 2) * turn / angle))
        q = product(q, d)
        q /= np.linalg.norm(q)
        out[i] = q
    return out


#: Variances that the published nine-axis filter starts from (accelerometer, gyroscope, its drift, linear
#: acceleration, magnetometer, magnetic disturbance), its two decay factors, field strength in uT and first error variances.
AHRS_NOISE = {"acc": 0.00019247, "gyr": 9.1385e-5, "drift": 3.0462e-13, "linear": 0.0096236, "mag": 0.1, "disturbance": 0.5}
AHRS_DECAY, AHRS_FIELD = 0.5, 50.0
AHRS_FIRST = [6.092348396e-6] * 3 + [7.6154354947e-5] * 3 + [0.009623610] * 3 + [0.6] * 3
GRAVITY = 9.81


def _skew(v: np.ndarray) -> np.ndarray:
    return np.array([[0.0, v[2], -v[1]], [-v[2], 0.0, v[0]], [v[1], -v[0], 0.0]])


def _turned(q: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """q followed by a rotation vector, of unit length."""
    angle = np.sqrt(rotation @ rotation)
    half = 0.5 - angle * angle / 48 if angle < 1e-4 else np.sin(angle / 2) / angle
    q = product(q, np.concatenate(([np.cos(angle / 2)], half * rotation)))
    return q / np.sqrt(q @ q)


def compass(acc: np.ndarray, mag: np.ndarray) -> np.ndarray:
    """Quaternion of the frame whose third axis lies along acc and whose first points to magnetic north."""
    down = acc / np.linalg.norm(acc)
    east = np.cross(down, mag)
    east = east / np.linalg.norm(east)
    return quaternion_of(np.stack((np.cross(east, down), east, down)))


def quaternion_of(r: np.ndarray) -> np.ndarray:
    """Unit quaternion with a positive first part of a rotation matrix."""
    four = np.array([1 + r[0, 0] + r[1, 1] + r[2, 2], 1 + r[0, 0] - r[1, 1] - r[2, 2], 1 - r[0, 0] + r[1, 1] - r[2, 2], 1 - r[0, 0] - r[1, 1] + r[2, 2]])
    k = int(four.argmax())
    pairs = [[four[0], r[2, 1] - r[1, 2], r[0, 2] - r[2, 0], r[1, 0] - r[0, 1]], [r[2, 1] - r[1, 2], four[1], r[0, 1] + r[1, 0], r[0, 2] + r[2, 0]], [r[0, 2] - r[2, 0], r[0, 1] + r[1, 0], four[2], r[1, 2] + r[2, 1]], [r[1, 0] - r[0, 1], r[0, 2] + r[2, 0], r[1, 2] + r[2, 1], four[3]]]
    q = np.array(pairs[k])
    return q / np.linalg.norm(q) * (-1 if q[0] < 0 else 1)


#: Numbers of an ``Ahrs`` state.
AHRS_STATE = 25


class Ahrs:
    """Orientation by an error-state Kalman filter over nine axes, as published for attitude and heading reference systems.

    The twelve errors are those of orientation, gyroscope offset, linear
    acceleration and magnetic disturbance; they are estimated anew at each
    sample from gravity and field as predicted and as measured, and taken out
    of the state. A field that is disturbed by more than twice its strength is
    not used.
    """

    def __init__(self, fs: float):
        self.fs, self.q = fs, None
        self.offset, self.linear = np.zeros(3), np.zeros(3)
        self.variance, self.field = np.array(AHRS_FIRST), np.array([AHRS_FIELD, 0.0, 0.0])

    def state(self) -> list[float] | None:
        """All that the filter knows, as numbers; None before the first sample."""
        if self.q is None:
            return None
        return np.concatenate((self.q, self.offset, self.linear, self.variance, self.field)).tolist()

    @staticmethod
    def of_state(fs: float, state: list[float] | None) -> Ahrs:
        """A filter that goes on from a state."""
        out = Ahrs(fs)
        if state is not None:
            x = np.array(state, float)
            out.q, out.offset, out.linear, out.variance, out.field = x[:4], x[4:7], x[7:10], x[10:22], x[22:25]
        return out

    def follow(self, rows: np.ndarray) -> list[list[float] | None]:
        """Orientations along rows of nine axes; a row with a missing axis keeps the last one, None before the first."""
        whole = np.isfinite(rows).all(1)
        out: list[list[float] | None] = []
        for row, good in zip(rows, whole.tolist(), strict=True):
            if good:
                self.step(row[:3], row[3:6], row[6:])
            out.append(None if self.q is None else self.q.tolist())
        return out

    def step(self, acc: np.ndarray, gyr: np.ndarray, mag: np.ndarray) -> np.ndarray:
        if self.q is None:
            self.q = self._first(acc, mag)
        dt, noise = 1 / self.fs, AHRS_NOISE
        q = _turned(self.q, (gyr - self.offset) * dt)
        r = matrix_of(q)
        gravity, field = GRAVITY * r[2], self.field @ r
        prior = AHRS_DECAY * self.linear
        seen = np.concatenate((gravity - (acc - prior), field - mag))

        p = np.diag(self._predicted(dt))
        cross = -dt * (self.variance[3:6] + noise["drift"])
        i = np.arange(3)
        p[i, i + 3] = p[i + 3, i] = cross
        h = np.zeros((6, 12))
        for k, v in ((0, gravity), (3, field)):
            h[k : k + 3, :3] = _skew(v)
            h[k : k + 3, 3:6] = -dt * h[k : k + 3, :3]
        h[i, i + 6], h[i + 3, i + 9] = 1.0, -1.0
        turn = dt * dt * (noise["drift"] + noise["gyr"])
        error = np.repeat((noise["acc"] + noise["linear"] + turn, noise["mag"] + noise["disturbance"] + turn), 3)

        gain = p @ h.T @ np.linalg.inv(h @ p @ h.T + np.diag(error))
        x = gain @ seen
        jammed = x[9:] @ x[9:] > 4 * AHRS_FIELD**2
        if jammed:
            x = p @ h[:3].T @ np.linalg.inv(h[:3] @ p @ h[:3].T + np.diag(error[:3])) @ seen[:3]
        self.variance = np.diag(p) - np.einsum("ij,ji->i", gain, h @ p)
        self.q = _turned(q, x[:3])
        self.offset, self.linear = self.offset + x[3:6], prior - x[6:9]
        if not jammed:
            self._point_field(self.field + matrix_of(self.q) @ x[9:])
        return self.q

    def _first(self, acc: np.ndarray, mag: np.ndarray) -> np.ndarray:
        if np.linalg.norm(np.cross(acc, mag)) == 0:
            return np.array([1.0, 0, 0, 0])
        q = compass(acc, mag)
        self._point_field(matrix_of(q) @ mag)
        return q

    def _point_field(self, field: np.ndarray) -> None:
        dip = np.clip(np.arctan2(field[2], field[0]), -np.pi / 2, np.pi / 2)
        self.field = AHRS_FIELD * np.array([np.cos(dip), 0.0, np.sin(dip)])

    def _predicted(self, dt: float) -> np.ndarray:
        v, noise = self.variance, AHRS_NOISE
        drift = v[3:6] + noise["drift"]
        return np.concatenate((v[:3] + dt * dt * (drift + noise["gyr"]), drift, AHRS_DECAY**2 * v[6:9] + noise["linear"], AHRS_DECAY**2 * v[9:] + noise["disturbance"]))


def product(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    a, b, c, d = p
    e, f, g, h = q
    return np.array([a * e - b * f - c * g - d * h, a * f + b * e + c * h - d * g, a * g - b * h + c * e + d * f, a * h + b * g - c * f + d * e])


def matrix_of(q: np.ndarray) -> np.ndarray:
    w, x, y, z = q
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])


class Vocoder:
    """Pitch changed and length kept: a phase vocoder stretches time, linear interpolation undoes it.

    Step k of the output takes its spectrum from between the frames beside
    k * rate, and its phase from the sum of the turns of the steps before. A part of the
    steps can thus be made from their frames and that sum alone.
    """

    def __init__(self, semitones: float, n: int = 1024):
        self.n, self.hop, self.rate, self.shape = n, n // 4, 2.0 ** (-semitones / 12), np.hanning(n)
        self.advance = 2 * np.pi * self.hop * np.arange(n // 2 + 1) / n
        #: Steps that overlap the one behind them.
        self.overlap = n // self.hop - 1

    def steps(self, length: int) -> int:
        """Steps that a signal of so many samples makes."""
        return len(np.arange(0, -(-(length + self.n // 2 + 1) // self.hop) - 1, self.rate))

    def frames(self, x: np.ndarray, first: int, low: int, high: int) -> np.ndarray:
        """Spectra of the frames low..high - 1; x begins at sample ``first``, zeros beyond it."""
        a, b = low * self.hop - self.n // 2, (high - 1) * self.hop + self.n // 2
        wide = np.zeros(b - a)
        i, j = max(a, first), min(b, first + len(x))
        if j > i:
            wide[i - a : j - a] = x[i - first : j - first]
        return np.fft.rfft(np.lib.stride_tricks.sliding_window_view(wide, self.n)[:: self.hop] * self.shape, axis=1)

    def turns(self, spectra: np.ndarray) -> np.ndarray:
        """What the phase goes on by from each frame to the next."""
        turn = np.diff(np.angle(spectra), axis=0) - self.advance
        return self.advance + turn - 2 * np.pi * np.round(turn / (2 * np.pi))

    def _of(self, x: np.ndarray, first: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the steps low..high - 1: frame (from the first used), place behind it, spectra and turns."""
        t = np.arange(low, high) * self.rate
        i = t.astype(int)
        spectra = self.frames(x, first, int(i[0]), int(i[-1]) + 2)
        return i - i[0], t - i, spectra, self.turns(spectra)

    def total(self, x: np.ndarray, first: int, low: int, high: int) -> np.ndarray:
        """Sum of the turns of the steps low..high - 1, and the first phase where they begin the signal."""
        i, _, spectra, turns = self._of(x, first, low, high)
        return turns[i].sum(0) + (np.angle(spectra[0]) if low == 0 else 0)

    def part(self, x: np.ndarray, first: int, low: int, high: int, last: int, phase: np.ndarray | None) -> tuple[np.ndarray, int]:
        """The stretched signal that the steps low..high - 1 of ``last`` complete, and its place; ``phase`` is that of step low."""
        a, b = max(0, low - self.overlap), min(high + 1, last)
        i, part, spectra, turns = self._of(x, first, a, b)
        sums = np.concatenate((np.zeros((1, turns.shape[1])), np.cumsum(turns[i], axis=0)))[: b - a]
        at = np.angle(spectra[0]) if phase is None else phase - sums[low - a]
        size = np.abs(spectra)
        size = (1 - part)[:, None] * size[i] + part[:, None] * size[i + 1]
        made = np.fft.irfft(size * np.exp(1j * (at + sums)), axis=1) * self.shape
        out, weight = np.zeros((b - a) * self.hop + self.n), np.zeros((b - a) * self.hop + self.n)
        for k in range(b - a):
            out[k * self.hop : k * self.hop + self.n] += made[k]
            weight[k * self.hop : k * self.hop + self.n] += self.shape**2
        return out / np.maximum(weight, 1e-8), a * self.hop

    def back(self, stretched: np.ndarray, place: int, m: np.ndarray) -> np.ndarray:
        """Output samples m of a stretched part that begins at ``place``."""
        at = m / self.rate + self.n // 2 - place
        return np.interp(at, np.arange(len(stretched)), stretched)

    def owned(self, low: int, high: int, last: int, length: int) -> np.ndarray:
        """Output samples that lie in the steps low..high - 1 of ``last``."""
        reach = lambda k: int((k * self.hop - self.n // 2) * self.rate)
        m = np.arange(max(0, reach(low) - 2), length if high >= last else min(length, reach(high) + 3))
        at = m / self.rate + self.n // 2
        return m[((at >= low * self.hop) | (low == 0)) & ((at < high * self.hop) | (high >= last))]


def pitch_shift(x: np.ndarray, semitones: float, n: int = 1024) -> np.ndarray:
    """``Vocoder`` over a whole signal."""
    x, v = np.asarray(x, float), Vocoder(semitones, n)
    last = v.steps(len(x))
    stretched, place = v.part(x, 0, 0, last, last, None)
    return v.back(stretched, place, np.arange(len(x)))


# -- frames -------------------------------------------------------------------------------

SIDE = 320
LINE_BYTES, LINE_HEAD = 492, 12
FRAME_BYTES = 160_000
#: Linear numbers (1-based) of the camera's sensor pixels that are repaired, in the order of their repair.
BAD_PIXELS = [
    7140, 6820, 6500, 6501, 6502, 13647, 13327, 13007, 13008, 13009, 33158, 32838, 32518, 32519, 32520, 85188, 84868, 84548, 84549, 84550,
    20154, 19834, 19514, 19515, 19516, 26652, 26332, 26012, 26013, 26014, 39666, 39346, 39026, 39027, 39028, 46164, 45844, 45524, 45525, 45526,
    52671, 52351, 52031, 52032, 52033, 59178, 58858, 58538, 58539, 58540, 65676, 65356, 65036, 65037, 65038, 72183, 71863, 71543, 71544, 71545,
    78690, 78370, 78050, 78051, 78052, 91695, 91375, 91055, 91056, 91057, 98202, 97882, 97562, 97563, 97564,
]


def deframe(raw: bytes) -> np.ndarray:
    """Payload bytes (320, 480) of a raw frame: 320 lines of 492 bytes, 12 of them a header."""
    lines = np.frombuffer(raw, np.uint8, SIDE * LINE_BYTES).reshape(SIDE, LINE_BYTES)
    return lines[:, LINE_HEAD:]


def unpack10(payload: np.ndarray) -> np.ndarray:
    """Pixels (0..1023) of bytes in threes, two pixels each; masks and shifts are fixed values of the sensor's format."""
    b = payload.reshape(-1, 3).astype(np.uint16)
    first = ((b[:, 0] & 0x7F) << 3) | (b[:, 1] >> 5)
    second = ((b[:, 1] & 0x07) << 7) | (b[:, 2] >> 1)
    return np.stack((first, second), 1).reshape(-1)


def repair(image: np.ndarray, bad: list[int]) -> np.ndarray:
    """Listed pixels, in order, become the median of their 3 x 3 neighbourhood, edge-clamped; later ones see earlier repairs. One image or a stack of them."""
    out = image.copy()
    w = out.shape[-1]
    for n in bad:
        r, c = divmod(n - 1, w)
        out[..., r, c] = np.median(out[..., max(0, r - 1) : r + 2, max(0, c - 1) : c + 2], axis=(-2, -1))
    return out


@functools.lru_cache(maxsize=8)
def _mosaic_weights(h: int, w: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(channel, where it is measured, summed weights of the neighbours that measure it) of a BGGR mosaic."""
    rows, cols = np.indices((h, w)) % 2
    masks = {2: (rows == 0) & (cols == 0), 1: rows != cols, 0: (rows == 1) & (cols == 1)}
    return [(channel, mask, np.maximum(_smoothed(mask.astype(float)), 1e-12)) for channel, mask in masks.items()]


def _smoothed(x: np.ndarray) -> np.ndarray:
    """Sum over the 3 x 3 neighbourhood with weights 1, 2, 1 each way, of the last two axes; zeros beyond the edge."""
    wide = np.pad(x, [(0, 0)] * (x.ndim - 1) + [(1, 1)])
    x = wide[..., :-2] + 2 * wide[..., 1:-1] + wide[..., 2:]
    wide = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(1, 1), (0, 0)])
    return wide[..., :-2, :] + 2 * wide[..., 1:-1, :] + wide[..., 2:, :]


def demosaic(mosaic: np.ndarray) -> np.ndarray:
    """Bilinear colours (..., h, w, RGB) of a BGGR mosaic or a stack of them; neighbours beyond the edge do not count."""
    mosaic = np.asarray(mosaic, float)
    out = np.empty((*mosaic.shape, 3))
    for channel, mask, weight in _mosaic_weights(*mosaic.shape[-2:]):
        out[..., channel] = np.where(mask, mosaic, _smoothed(np.where(mask, mosaic, 0.0)) / weight)
    return out


def brightness(image: np.ndarray, target: float = 160.0) -> np.ndarray:
    mean = image.mean()
    return image.astype(np.uint8) if mean == 0 else np.clip(image * (target / mean), 0, 255).astype(np.uint8)


def equalise(luma: np.ndarray) -> np.ndarray:
    """Histogram equalisation of 8-bit values."""
    counts = np.bincount(luma.reshape(-1), minlength=256)
    cdf = np.cumsum(counts)
    low = cdf[np.flatnonzero(counts)[0]]
    if low == cdf[-1]:
        return luma.copy()
    return np.clip(np.round((cdf - low) * 255.0 / (cdf[-1] - low)), 0, 255).astype(np.uint8)[luma]


def equalise_luminance(rgb: np.ndarray) -> np.ndarray:
    """Equalised luma with the chroma kept."""
    weights = np.array([0.299, 0.587, 0.114])
    luma = rgb @ weights
    even = equalise(np.clip(np.round(luma), 0, 255).astype(np.uint8)).astype(float)
    return np.clip(rgb + (even - luma)[..., None], 0, 255).astype(np.uint8)


def decode_stack(raws: list[bytes], bad: list[int] | None = None, target: float | None = 160.0) -> np.ndarray:
    """RGB (n, 320, 320, 3), 8 bits, of raw frames: unpack, scale, repair, rotate, colours, brightness of each."""
    images = unpack10(np.stack([deframe(r) for r in raws])).reshape(-1, SIDE, SIDE) / 4.0
    images = repair(images, bad) if bad else images
    rgb = demosaic(np.rot90(images, 2, (1, 2)).astype(np.uint16))
    return np.stack([brightness(x, target) for x in rgb]) if target else np.clip(rgb, 0, 255).astype(np.uint8)


def decode_frame(raw: bytes, bad: list[int] | None = None, target: float | None = 160.0) -> np.ndarray:
    return decode_stack([raw], bad, target)[0]


def letterbox(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize that keeps the aspect ratio, centred on black."""
    h, w = image.shape[:2]
    scale = min(height / h, width / w)
    nh, nw = max(1, round(h * scale)), max(1, round(w * scale))
    r, c = np.clip((np.arange(nh) + 0.5) / scale - 0.5, 0, h - 1), np.clip((np.arange(nw) + 0.5) / scale - 0.5, 0, w - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    extra = (1,) * (image.ndim - 2)
    fr, fc = (r - r0).reshape(-1, 1, *extra), (c - c0).reshape(1, -1, *extra)
    x = image.astype(float)
    mixed = x[r0][:, c0] * (1 - fr) * (1 - fc) + x[r1][:, c0] * fr * (1 - fc) + x[r0][:, c1] * (1 - fr) * fc + x[r1][:, c1] * fr * fc
    out = np.zeros((height, width, *image.shape[2:]), image.dtype)
    top, left = (height - nh) // 2, (width - nw) // 2
    out[top : top + nh, left : left + nw] = np.round(mixed) if image.dtype.kind in "iu" else mixed
    return out
