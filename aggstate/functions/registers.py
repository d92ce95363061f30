"""Register arrays of distinct-count states: layouts, packing, extraction and estimates, in numpy.

A register array holds for each of 2**K buckets the largest rank seen.  Union is the elementwise maximum, so states merge in
any order and repeats don't count.
"""

from __future__ import annotations

import math

import numpy as np

U64 = np.uint64
# Fixed values of the layouts: the 12-bit state's sizes, and the container types of the combined state.
HLL12_K, HLL12_WIDTH, HLL12_CAP = 12, 5, 21
SMALL, MEDIUM, LARGE = 1, 2, 3
LEAST_K, MOST_K = 12, 20


def pack(values: np.ndarray, width: int) -> bytes:
    """Numbers of width bits each, lowest bit first."""
    bits = (np.asarray(values, np.uint8)[:, None] >> np.arange(width, dtype=np.uint8)) & 1
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: width * count].reshape(count, width)
    return (bits << np.arange(width, dtype=np.uint8)).sum(1).astype(np.uint8)


def _checked(registers, count: int, cap: int) -> np.ndarray:
    values = np.asarray(registers, np.int64)
    if values.shape != (count,):
        raise ValueError(f"expected {count} registers")
    if (values < 0).any():
        raise ValueError("a register is negative")
    return np.minimum(values, cap).astype(np.uint8)


# ---- the 12-bit state: type byte, registers of 5 bits, histogram of ranks, zeros


def encode_hll12(registers) -> bytes:
    values = _checked(registers, 1 << HLL12_K, HLL12_CAP)
    histogram = np.bincount(values, minlength=HLL12_CAP + 1).astype("<u4")
    return b"\x01" + pack(values, HLL12_WIDTH) + histogram.tobytes() + np.uint16(histogram[0]).astype("<u2").tobytes()


def hll12_size() -> int:
    return 1 + (HLL12_WIDTH << HLL12_K) // 8 + 4 * (HLL12_CAP + 1) + 2


def decode_hll12(state: bytes) -> np.ndarray:
    """Registers of a dense state; a small one, or one of another size, raises."""
    if state[:1] != b"\x01" or len(state) != hll12_size():
        raise ValueError("not a dense state")
    return unpack(state[1:], HLL12_WIDTH, 1 << HLL12_K)


def hll12_histogram(state: bytes) -> tuple[np.ndarray, int]:
    at = hll12_size() - 4 * (HLL12_CAP + 1) - 2
    return np.frombuffer(state, "<u4", HLL12_CAP + 1, at).astype(np.int64), int.from_bytes(state[-2:], "little")


def hll12_small(state: bytes) -> np.ndarray | None:
    """The hashes of a small state (at most 16), or None."""
    if state[:1] == b"\x00" and len(state) >= 2 and state[1] <= 16 and len(state) == 2 + 8 * state[1]:
        return np.frombuffer(state, "<u8", state[1], 2)
    return None


# ---- the combined state at K: type byte, registers of 6 bits, histogram, zeros


def layout(k: int) -> dict:
    if not LEAST_K <= k <= MOST_K:
        raise ValueError(f"K must be from {LEAST_K} to {MOST_K}")
    cap = 65 - k
    zeros = 2 if k < 16 else 4
    registers = (6 << k) // 8
    return {"cap": cap, "registers": registers, "ranks": cap + 1, "zeros": zeros, "size": 1 + registers + 4 * (cap + 1) + zeros}


def encode_combined(registers, k: int) -> bytes:
    shape = layout(k)
    values = _checked(registers, 1 << k, shape["cap"])
    histogram = np.bincount(values, minlength=shape["ranks"]).astype("<u4")
    return bytes([LARGE]) + pack(values, 6) + histogram.tobytes() + int(histogram[0]).to_bytes(shape["zeros"], "little")


def decode_combined(state: bytes, k: int) -> np.ndarray:
    if state[:1] != bytes([LARGE]) or len(state) != layout(k)["size"]:
        raise ValueError("not a large state of this K")
    return unpack(state[1:], 6, 1 << k)


def combined_trailer(state: bytes, k: int) -> tuple[np.ndarray, int]:
    shape = layout(k)
    at = 1 + shape["registers"]
    return np.frombuffer(state, "<u4", shape["ranks"], at).astype(np.int64), int.from_bytes(state[-shape["zeros"] :], "little")


def container(state: bytes) -> str:
    return {SMALL: "small", MEDIUM: "medium", LARGE: "large"}.get(state[0] if state else 0, "unknown")


def target_k(lg_k: int) -> int:
    """The K that a sketch of 2**lg_k buckets goes to."""
    if lg_k < LEAST_K:
        raise ValueError(f"a sketch of fewer than 2**{LEAST_K} buckets can't be carried over")
    return min(lg_k, MOST_K)


def int_hash64(values) -> np.ndarray:
    """The integer hash of native states: a 64-bit finaliser."""
    x = np.asarray(values).astype(np.int64).view(U64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> U64(33)
        x *= U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x *= U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


def buckets_and_ranks(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket: the low K bits; rank: one more than the zeros at the end of the rest, the cap if the rest is zero."""
    tail = hashes >> U64(k)
    low = tail & (~tail + U64(1))
    rank = np.where(tail == 0, layout(k)["cap"], np.bitwise_count(low - U64(1)).astype(np.int64) + 1)
    return (hashes & U64((1 << k) - 1)).astype(np.int64), rank


def native_registers(hashes: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(1 << k, np.int64)
    np.maximum.at(out, *buckets_and_ranks(hashes, k))
    return out


def fold(registers: np.ndarray, k: int) -> np.ndarray:
    """Fewer buckets: the maximum over those with the same low K bits."""
    values = np.asarray(registers)
    if len(values) < 1 << k:
        raise ValueError("registers can't be unfolded")
    return values.reshape(-1, 1 << k).max(0)


def union(*arrays: np.ndarray) -> np.ndarray:
    return np.maximum.reduce(arrays)


def estimate(registers: np.ndarray) -> float:
    """Linear counting up to 2.5 times the buckets while any is empty, the raw estimate above."""
    values = np.asarray(registers, np.int64)
    m = len(values)
    raw = 0.7213 / (1 + 1.079 / m) * m * m / np.exp2(-values.astype(float)).sum()
    zeros = int((values == 0).sum())
    return m * math.log(m / zeros) if raw <= 2.5 * m and zeros else float(raw)


# ---- HLL sketches of the published sketch library


LIST, SET, DENSE = 0, 1, 2
TYPES = {0: "HLL_4", 1: "HLL_6", 2: "HLL_8"}


def preamble(sketch: bytes) -> dict:
    """The header's fields; bytes of another family raise."""
    if len(sketch) < 8 or sketch[2] != 7:
        raise ValueError("not an HLL sketch")
    return {"pre_ints": sketch[0] & 0x3F, "ser_ver": sketch[1], "family": sketch[2], "lg_k": sketch[3], "lg_arr": sketch[4], "flags": sketch[5], "count_or_min": sketch[6], "mode": sketch[7] & 3, "type": TYPES[(sketch[7] >> 2) & 3], "empty": bool(sketch[5] & 4)}


def coupons(sketch: bytes) -> np.ndarray:
    """Coupons of a LIST or SET sketch (slot in the low 26 bits, rank above); padding words are skipped."""
    words = np.frombuffer(sketch, "<u4", offset=(sketch[0] & 0x3F) * 4)
    return words[words != 0]


def sketch_registers(sketch: bytes, k: int | None = None) -> np.ndarray:
    """Registers of any representation, folded to 2**k buckets."""
    head = preamble(sketch)
    lg = head["lg_k"]
    k = lg if k is None else k
    if k > lg:
        raise ValueError("registers can't be unfolded")
    m = 1 << lg
    if head["mode"] in (LIST, SET):
        out = np.zeros(m, np.int64)
        found = coupons(sketch)
        np.maximum.at(out, (found & 0x3FFFFFF).astype(np.int64) & (m - 1), (found >> 26).astype(np.int64))
    elif head["type"] == "HLL_8":
        out = np.frombuffer(sketch, np.uint8, m, 40).astype(np.int64)
    elif head["type"] == "HLL_6":
        out = unpack(sketch[40:], 6, m).astype(np.int64)
    else:
        raw = np.frombuffer(sketch, np.uint8, m // 2, 40)
        nibbles = np.stack([raw & 15, raw >> 4], 1).ravel().astype(np.int64)
        out = nibbles + head["count_or_min"]
        extra = np.frombuffer(sketch[40 + m // 2 :][: (len(sketch) - 40 - m // 2) // 4 * 4], "<u4")
        extra = extra[extra != 0]
        out[(extra & 0x3FFFFFF).astype(np.int64) & (m - 1)] = (extra >> 26).astype(np.int64)
    return fold(out, k)


def hll12_from_sketch(sketch: bytes) -> bytes:
    return encode_hll12(sketch_registers(sketch, HLL12_K))


def combined_from_sketch(sketch: bytes, k: int) -> bytes:
    return encode_combined(sketch_registers(sketch, k), k)


# ---- compact theta sketches


def theta_preamble(sketch: bytes) -> dict:
    if len(sketch) < 8 or sketch[2] != 3:
        raise ValueError("not a theta sketch")
    longs = sketch[0] & 0x3F
    out = {"pre_longs": longs, "ser_ver": sketch[1], "flags": sketch[5], "seed_hash": int.from_bytes(sketch[6:8], "little")}
    if sketch[1] == 3:
        out["retained"] = 0 if sketch[5] & 4 else int.from_bytes(sketch[8:12], "little") if longs >= 2 else 1
        out["theta"] = int.from_bytes(sketch[16:24], "little") if longs >= 3 else (1 << 63) - 1
    return out


def theta_uncompressed(sketch: bytes) -> bytes:
    """A compact sketch of serial version 3 with the same entries; version 4 (packed differences) is unpacked."""
    if sketch[1] == 3:
        return sketch
    if sketch[1] != 4 or sketch[2] != 3:
        raise ValueError("not a compact theta sketch")
    longs, width, counted = sketch[0] & 0x3F, sketch[3], sketch[4]
    at, theta = 8, (1 << 63) - 1
    if longs > 1:
        theta, at = int.from_bytes(sketch[8:16], "little"), 16
    n = int.from_bytes(sketch[at : at + counted], "little")
    bits = np.unpackbits(np.frombuffer(sketch, np.uint8, offset=at + counted))[: n * width].reshape(n, width).astype(U64)
    steps = (bits << np.arange(width - 1, -1, -1, dtype=U64)).sum(1, dtype=U64)
    entries = np.cumsum(steps, dtype=U64).astype("<u8").tobytes()
    exact = theta == (1 << 63) - 1
    head = bytes([2 if exact else 3, 3, 3, 0, 0, sketch[5]]) + sketch[6:8] + n.to_bytes(4, "little") + b"\0" * 4
    return head + (b"" if exact else theta.to_bytes(8, "little")) + entries
