"""Quantile sketches as bytes: reading KLL sketches of doubles, building, merging and reading classic ones, and weighted digests.

Everything that a sketch knows is a weighted sample: ascending values and whole weights that sum to n.  Ranks, quantiles
and replays all follow from it.
"""

from __future__ import annotations

import struct

import numpy as np

Sample = tuple[np.ndarray, np.ndarray]
_EMPTY: Sample = (np.zeros(0), np.zeros(0, np.int64))
# Family numbers and flags of the published formats.
CLASSIC, KLL = 8, 15
CLASSIC_EMPTY, CLASSIC_COMPACT, CLASSIC_ORDERED = 4, 8, 16


def _sorted(values: np.ndarray, weights: np.ndarray) -> Sample:
    order = np.argsort(values, kind="stable")
    return values[order], weights[order].astype(np.int64)


def info(sketch: bytes) -> dict:
    """Family, n, k, min and max of a sketch (min and max are None if it is empty)."""
    family = sketch[2] if len(sketch) >= 8 else None
    k = int.from_bytes(sketch[4:6], "little")
    if family == KLL:
        if sketch[3] & 1:
            return {"family": "kll", "n": 0, "k": k, "min": None, "max": None}
        if sketch[1] == 2:
            value = struct.unpack_from("<d", sketch, 8)[0]
            return {"family": "kll", "n": 1, "k": k, "min": value, "max": value}
        low, high = struct.unpack_from("<2d", sketch, 20 + 4 * sketch[18])
        return {"family": "kll", "n": int.from_bytes(sketch[8:16], "little"), "k": k, "min": low, "max": high}
    if family == CLASSIC:
        if sketch[3] & CLASSIC_EMPTY:
            return {"family": "classic", "n": 0, "k": k, "min": None, "max": None}
        low, high = struct.unpack_from("<2d", sketch, 16)
        return {"family": "classic", "n": int.from_bytes(sketch[8:16], "little"), "k": k, "min": low, "max": high}
    raise ValueError("not a quantile sketch of a known family")


def rank_error(sketch: bytes) -> float:
    """The normalised rank error of a single sketch of its family and k."""
    head = info(sketch)
    a, b = (2.296, 0.9723) if head["family"] == "kll" else (1.576, 0.9726)
    return a / head["k"] ** b


def sample(sketch: bytes) -> Sample:
    """The weighted sample that a KLL or classic sketch of doubles holds."""
    head = info(sketch)
    if not head["n"]:
        return _EMPTY
    if head["family"] == "classic":
        return _classic_sample(sketch, head["n"], head["k"])
    if sketch[1] == 2:
        return np.array([head["min"]]), np.ones(1, np.int64)
    levels = sketch[18]
    starts = np.frombuffer(sketch, "<u4", levels, 20).astype(np.int64)
    values = np.frombuffer(sketch, "<f8", offset=20 + 4 * levels + 16)
    edges = np.append(starts, starts[0] + len(values)) - starts[0]
    return _sorted(values, np.repeat(1 << np.arange(levels), np.diff(edges)))


def quantiles(of: Sample, ranks: np.ndarray) -> np.ndarray:
    """The values whose cumulative weight first exceeds each normalised rank."""
    values, weights = of
    ends = np.cumsum(weights)
    return values[np.minimum(np.searchsorted(ends, np.asarray(ranks) * ends[-1], "right"), len(values) - 1)]


def rank(of: Sample, value: float, inclusive: bool = False) -> float:
    """The share of weight below value, or not above it."""
    values, weights = of
    if not len(values):
        return float("nan")
    return float(weights[: np.searchsorted(values, value, "right" if inclusive else "left")].sum() / weights.sum())


def replay(of: Sample, most: int) -> Sample:
    """At most ``most`` values at evenly spaced ranks, with weights as even as can be that sum to n; the heavier ones first."""
    n = int(of[1].sum())
    m = min(n, most)
    if not m:
        return _EMPTY
    weights = np.full(m, n // m, np.int64)
    weights[: n % m] += 1
    return quantiles(of, (np.arange(m) + 0.5) / m), weights


# ---- classic sketches


class Classic:
    """A classic quantile sketch: a base buffer of up to 2k values, and levels of k values whose weights double."""

    def __init__(self, k: int = 256, seed: int = 0) -> None:
        self.k, self.n, self.base, self.levels = k, 0, np.zeros(0), []
        self.low, self.high, self.rng = np.inf, -np.inf, np.random.default_rng(seed)

    def _carry(self, level: int, values: np.ndarray) -> None:
        """Puts k values into a level; two of them become one of the next level."""
        while True:
            while len(self.levels) <= level:
                self.levels.append(None)
            if self.levels[level] is None:
                self.levels[level] = values
                return
            both = np.sort(np.concatenate([self.levels[level], values]))
            self.levels[level], values, level = None, both[int(self.rng.integers(2)) :: 2], level + 1

    def update(self, values: np.ndarray) -> Classic:
        values = np.asarray(values, float)
        values = values[~np.isnan(values)]
        if len(values):
            self.n += len(values)
            self.low, self.high = min(self.low, values.min()), max(self.high, values.max())
            self._add(values)
        return self

    def _add(self, values: np.ndarray) -> None:
        flow = np.concatenate([self.base, values])
        full = len(flow) // (2 * self.k) * 2 * self.k
        for lo in range(0, full, 2 * self.k):
            self._carry(0, np.sort(flow[lo : lo + 2 * self.k])[int(self.rng.integers(2)) :: 2])
        self.base = flow[full:]

    def merge(self, other: Classic) -> Classic:
        if other.k != self.k:
            raise ValueError("classic sketches of different k")
        if other.n:
            self.n += other.n
            self.low, self.high = min(self.low, other.low), max(self.high, other.high)
            for level, values in enumerate(other.levels):
                if values is not None:
                    self._carry(level, values)
            self._add(other.base)
        return self

    def tobytes(self) -> bytes:
        """The compact, ordered form of serial version 3."""
        flags = CLASSIC_COMPACT | CLASSIC_ORDERED | 2
        if not self.n:
            return bytes([1, 3, CLASSIC, flags | CLASSIC_EMPTY]) + self.k.to_bytes(2, "little") + b"\0\0"
        kept = [np.sort(self.base), *[v for v in self.levels if v is not None]]
        return bytes([2, 3, CLASSIC, flags]) + self.k.to_bytes(2, "little") + b"\0\0" + struct.pack("<q2d", self.n, self.low, self.high) + np.concatenate(kept).astype("<f8").tobytes()

    @classmethod
    def open(cls, sketch: bytes) -> Classic:
        head = info(sketch)
        if head["family"] != "classic" or (head["n"] and not sketch[3] & CLASSIC_COMPACT):
            raise ValueError("not a compact classic sketch")
        out = cls(head["k"])
        if head["n"]:
            out.n, out.low, out.high = head["n"], head["min"], head["max"]
            values, at = np.frombuffer(sketch, "<f8", offset=32), head["n"] % (2 * out.k)
            out.base, pattern = values[:at].copy(), head["n"] // (2 * out.k)
            while pattern:
                out.levels.append(values[at : at + out.k].copy() if pattern & 1 else None)
                at += out.k * (pattern & 1)
                pattern >>= 1
        return out


def _classic_sample(sketch: bytes, n: int, k: int) -> Sample:
    opened = Classic.open(sketch)
    parts = [(opened.base, 1), *[(v, 2 << i) for i, v in enumerate(opened.levels) if v is not None]]
    return _sorted(np.concatenate([v for v, _ in parts]), np.concatenate([np.full(len(v), w, np.int64) for v, w in parts]))


# ---- weighted digests


def digest(values: np.ndarray, weights: np.ndarray, most: int = 1000) -> Sample:
    """A weighted sample of about ``most`` centroids at most: equal values are joined, then neighbours, small ones near both ends."""
    values, weights = np.asarray(values, float), np.asarray(weights, np.int64)
    known = ~np.isnan(values) & (weights > 0)
    values, weights = _sorted(values[known], weights[known])
    if len(values):
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        values, weights = values[first], np.add.reduceat(weights, first)
    if len(values) > most:
        middle = (np.cumsum(weights) - weights / 2) / weights.sum()
        cell = np.floor(most * (np.arcsin(2 * middle - 1) / np.pi + 0.5)).astype(np.int64)
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        total = np.add.reduceat(weights, first)
        values, weights = np.add.reduceat(values * weights, first) / total, total
    return values, weights


def seal(of: Sample) -> bytes:
    """A digest's bytes: ``WDG1``, the number of centroids, values, weights."""
    return b"WDG1" + struct.pack("<I", len(of[0])) + of[0].astype("<f8").tobytes() + of[1].astype("<i8").tobytes()


def unseal(state: bytes) -> Sample:
    if state[:4] != b"WDG1" or len(state) != 8 + 16 * (n := struct.unpack_from("<I", state, 4)[0]):
        raise ValueError("not a weighted digest")
    return np.frombuffer(state, "<f8", n, 8), np.frombuffer(state, "<i8", n, 8 + 8 * n)


def digest_quantile(of: Sample, level: float) -> float:
    """The first centroid whose cumulative weight reaches level of the total; nan of an empty digest."""
    values, weights = of
    if not len(values):
        return float("nan")
    ends = np.cumsum(weights)
    return float(values[min(np.searchsorted(ends, level * ends[-1] * (1 - 1e-12)), len(values) - 1)])
