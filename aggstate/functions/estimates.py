"""Distinct-count estimates of published HLL sketches as doubles, their bounds, and a summary text, from the bytes.

A sketch of coupons (LIST, SET) counts them and adds what collisions hide: two values share a coupon with a chance of one in
3 * 2**26.  A dense sketch that was only updated carries its historic inverse probability (HIP) estimate.  A dense sketch
that came from a union has lost it; its registers are estimated by the improved raw estimator of O. Ertl, "New cardinality
estimation algorithms for HyperLogLog sketches" (2017), which needs no tables of bias.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from . import registers as R

COUPON_PAIRS = 3 << 26
COUPON_ERROR = 0.409 / (1 << 13)
# Relative errors by lgK up to 12 (below and above, updated; below and above, united) at one and two standard deviations.
RELATIVE_ERRORS = {
    1: {
        4: (0.207316195, 0.207805347, 0.254409839, 0.256980172),
        5: (0.146981579, 0.146988328, 0.181817353, 0.182332109),
        6: (0.104026721, 0.103877775, 0.129432281, 0.129314228),
        7: (0.073614601, 0.073452978, 0.091640655, 0.091584836),
        8: (0.052052480, 0.051982806, 0.064858051, 0.064874110),
        9: (0.036770852, 0.036768609, 0.045851855, 0.045914650),
        10: (0.025990219, 0.025991325, 0.032454144, 0.032433119),
        11: (0.018373987, 0.018345330, 0.022921382, 0.022960633),
        12: (0.012936253, 0.012920332, 0.016155679, 0.016186662),
    },
    2: {
        4: (0.502865572, 0.355574279, 0.682266712, 0.411905944),
        5: (0.335426881, 0.262390832, 0.443389054, 0.310275547),
        6: (0.227683872, 0.191503663, 0.295782195, 0.230142294),
        7: (0.156781585, 0.138513438, 0.201175925, 0.168340130),
        8: (0.108783763, 0.099703123, 0.138523393, 0.122045231),
        9: (0.075727545, 0.071381580, 0.095925072, 0.087845050),
        10: (0.053145536, 0.050854296, 0.067009668, 0.062897613),
        11: (0.037266176, 0.036121138, 0.046868565, 0.044875401),
        12: (0.026138290, 0.025572893, 0.032825719, 0.031827816),
    },
}


def coupon_estimate(count: int) -> float:
    return count + count * (count - 1) / (2 * COUPON_PAIRS)


def improved_estimate(registers: np.ndarray) -> float:
    """Ertl's improved raw estimate of any register array."""
    m = len(registers)
    counts = np.bincount(np.asarray(registers, np.int64))
    empty = counts[0] / m
    if empty == 1:
        return 0.0
    # sum over k of 2**(k-1) * empty**(2**k), from the empty registers
    power, weight, sigma = empty, 1.0, empty
    while power:
        power *= power
        before = sigma
        sigma += power * weight
        weight *= 2
        if sigma == before:
            break
    rest = float((counts[1:] * np.exp2(-np.arange(1, len(counts)))).sum())
    return m * m / (2 * math.log(2)) / (m * sigma + rest)


def _parts(sketch: bytes) -> tuple[dict, bool]:
    """The header, and whether the sketch has lost the order of its updates."""
    head = R.preamble(sketch)
    return head, bool(head["flags"] & 16)


def estimate(sketch: bytes) -> float:
    head, united = _parts(sketch)
    if head["empty"]:
        return 0.0
    if head["mode"] != R.DENSE:
        return coupon_estimate(len(R.coupons(sketch)))
    return improved_estimate(R.sketch_registers(sketch)) if united else struct.unpack_from("<d", sketch, 8)[0]


def bounds(sketch: bytes, deviations: int = 2) -> tuple[float, float]:
    """Lower and upper bound at one or two standard deviations."""
    head, united = _parts(sketch)
    value = estimate(sketch)
    if head["empty"]:
        return 0.0, 0.0
    if head["mode"] != R.DENSE:
        least = len(R.coupons(sketch))
        below = above = deviations * COUPON_ERROR
    else:
        least = int(np.count_nonzero(R.sketch_registers(sketch)))
        if head["lg_k"] > 12:
            below = above = deviations * math.sqrt(3 * math.log(2) - 1 if united else math.log(2)) / math.sqrt(1 << head["lg_k"])
        else:
            below, above = RELATIVE_ERRORS[deviations][head["lg_k"]][2 * united : 2 * united + 2]
    return max(value / (1 + below), float(least)), value / (1 - above)


def summary(sketch: bytes) -> str:
    """A sketch in words: its header, estimate and bounds of one standard deviation, and what its representation holds."""
    head, united = _parts(sketch)
    low, high = bounds(sketch, 1)
    rows = {"Log Config K": head["lg_k"], "Hll Target": head["type"], "Current Mode": ("LIST", "SET", "HLL")[head["mode"]], "Memory": "false", "LB": low, "Estimate": estimate(sketch), "UB": high, "OutOfOrder Flag": str(united).lower()}
    if head["mode"] != R.DENSE:
        rows["Coupon Count"] = 0 if head["empty"] else len(R.coupons(sketch))
    else:
        hip, kxq0, kxq1 = struct.unpack_from("<3d", sketch, 8)
        rows |= {"CurMin": head["count_or_min"], "NumAtCurMin": int.from_bytes(sketch[32:36], "little"), "HipAccum": hip, "KxQ0": kxq0, "KxQ1": kxq1}
    return "\n".join(["### HLL SKETCH SUMMARY:", *[f"  {k:<15}: {v}" for k, v in rows.items()]])


# ---- theta


def theta_estimate(sketch: bytes) -> float:
    """Retained entries over theta."""
    head = R.theta_preamble(R.theta_uncompressed(sketch))
    return head["retained"] / (head["theta"] / ((1 << 63) - 1))
