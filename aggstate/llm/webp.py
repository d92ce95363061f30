"""Lossless WebP as a media column: a decoder for the whole VP8L format, and a writer for payloads.

``decode`` reads prefix codes (simple and normal, several groups), back-references with the short distances of the
neighbourhood, the colour cache, and inverts the predictor, cross-colour, subtract-green and palette transforms.  Where a
picture holds nothing but literals of one code, the code lengths at all bit places are looked up at once in numpy, and
only the walk from code to code is a Python step; other pictures are read symbol by symbol.

A payload is laid out as an RGB picture of 64 columns, 192 bytes a row.  A payload of more rows than a picture can have
becomes several pictures, one after the other.  Most pictures hold literals of one fixed complete prefix code for all three
channels (stored in each, as the format wants).  A picture whose pixels repeat themselves in runs, a fifth of them or more,
gets prefix codes of its own, back-references, and a colour cache where that makes it smaller; one of at most 16 colours
gets a palette, several pixels to a byte; the plain form is kept if it is shorter.  The writer uses no predictor, cross-colour or subtract-green
transform: text has no neighbouring values that resemble each other.

Null and empty texts are one row of spaces.  Repeated rows are stored each, with equal values.  Only the named columns
are read.  Bytes that are no lossless WebP raise ValueError; a null picture gives null.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import zlib
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrays_batch, portions, table

COLUMNS, ROW, MOST_ROWS = 64, 192, 16384
# The order in which lengths of the code-length code are stored.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
LITERALS, LENGTHS, DISTANCES = 256, 24, 40


@functools.cache
def neighbourhood() -> list[tuple[int, int]]:
    """The 120 nearby places (left, up) of short distance codes, nearest first."""
    places = [(x, y) for y in range(8) for x in range(-7, 9) if y or x > 0]
    return sorted(places, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), -p[0]))


class Bits:
    """Bits of bytes, lowest first."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data + b"\0" * 16, at
        self.end = len(data) * 8

    def peek(self) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 4], "little") >> (self.at & 7)

    def read(self, n: int) -> int:
        if self.at + n > self.end:
            raise ValueError("the picture ends too early")
        value = self.peek() & ((1 << n) - 1)
        self.at += n
        return value


class Code:
    """A canonical prefix code; table entries are symbol * 16 + length by the next bits."""

    def __init__(self, lengths: Sequence[int]) -> None:
        self.lengths = tuple(lengths)
        used = [s for s, n in enumerate(lengths) if n]
        self.only = used[0] if len(used) == 1 else None
        if not used:
            self.only = 0
        self.width = 0 if self.only is not None else max(lengths)
        if self.only is not None:
            self.table = [self.only * 16]
            return
        if sum(1 << (self.width - lengths[s]) for s in used) != 1 << self.width:
            raise ValueError("a prefix code isn't complete")
        self.table, code, last = [0] * (1 << self.width), 0, 0
        self.words: dict[int, tuple[int, int]] = {}
        for s in sorted(used, key=lambda s: (lengths[s], s)):
            n = lengths[s]
            code <<= n - last
            last = n
            turned = int(f"{code:0{n}b}"[::-1], 2)
            self.words[s] = (turned, n)
            self.table[turned :: 1 << n] = [s * 16 + n] * (1 << (self.width - n))
            code += 1

    @functools.cached_property
    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Length and symbol (of literals) by the next bits."""
        entries = np.array(self.table, np.uint32)
        return (entries & 15).astype(np.uint8), (entries >> 4).astype(np.uint8)

    def read(self, bits: Bits) -> int:
        entry = self.table[bits.peek() & ((1 << self.width) - 1)]
        bits.at += entry & 15
        return entry >> 4


def read_code(bits: Bits, symbols: int) -> Code:
    lengths = [0] * symbols
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        found = [bits.read(8 if wide else 1)]
        if two:
            found.append(bits.read(8))
        for s in found:
            if s >= symbols:
                raise ValueError("a symbol outside its alphabet")
            lengths[s] = 1
        return Code(lengths)
    own = [0] * 19
    for k in range(4 + bits.read(4)):
        own[LENGTH_ORDER[k]] = bits.read(3)
    code = Code(own)
    most = symbols
    if bits.read(1):
        most = 2 + bits.read(2 + 2 * bits.read(3))
        if most > symbols:
            raise ValueError("more code lengths than symbols")
    at, before = 0, 8
    while at < symbols and most:
        most -= 1
        token = code.read(bits)
        if token < 16:
            lengths[at] = token
            at += 1
            before = token or before
            continue
        value, times = (before, 3 + bits.read(2)) if token == 16 else (0, 3 + bits.read(3) if token == 17 else 11 + bits.read(7))
        if at + times > symbols:
            raise ValueError("more code lengths than symbols")
        lengths[at : at + times] = [value] * times
        at += times
    return Code(lengths)


def _extra(bits: Bits, symbol: int) -> int:
    """The value that a length or distance symbol stands for, with its extra bits."""
    if symbol < 4:
        return symbol + 1
    n = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << n) + bits.read(n) + 1


def _groups(bits: Bits, count: int, cache: int) -> list[tuple[Code, ...]]:
    sizes = (LITERALS + LENGTHS + ((1 << cache) if cache else 0), LITERALS, LITERALS, LITERALS, DISTANCES)
    return [tuple(read_code(bits, n) for n in sizes) for _ in range(count)]


def _cache_bits(bits: Bits) -> int:
    if not bits.read(1):
        return 0
    n = bits.read(4)
    if not 1 <= n <= 11:
        raise ValueError("a colour cache of a wrong size")
    return n


def _pixels(bits: Bits, width: int, height: int, cache: int, groups: list, entropy: np.ndarray | None, shift: int) -> np.ndarray:
    """ARGB values read symbol by symbol."""
    total = width * height
    out, held = [], [0] * (1 << cache) if cache else []
    stored = 0  # how many pixels have gone into the cache

    def remember():
        nonlocal stored
        for v in out[stored:]:
            held[(0x1E35A7BD * v & 0xFFFFFFFF) >> (32 - cache)] = v
        stored = len(out)

    data, at, end, start = bits.data, bits.at, bits.end, int.from_bytes
    tables = [[(c.table, (1 << c.width) - 1) for c in g[:4]] for g in groups]
    (gt, gm), (rt, rm), (bt, bm), (at_, am) = tables[0]
    group = groups[0]
    n = 0
    while n < total:
        if at > end:
            raise ValueError("the picture ends too early")
        if entropy is not None:
            k = entropy[n // width >> shift, n % width >> shift]
            group = groups[k]
            (gt, gm), (rt, rm), (bt, bm), (at_, am) = tables[k]
        i = at >> 3
        window = start(data[i : i + 9], "little") >> (at & 7)  # four codes have 60 bits at most
        entry = gt[window & gm]
        used, green = entry & 15, entry >> 4
        if green < LITERALS:
            red = rt[window >> used & rm]
            used += red & 15
            blue = bt[window >> used & bm]
            used += blue & 15
            alpha = at_[window >> used & am]
            at += used + (alpha & 15)
            out.append((alpha >> 4) << 24 | (red >> 4) << 16 | green << 8 | blue >> 4)
            n += 1
        elif green < LITERALS + LENGTHS:
            bits.at = at + used
            length = _extra(bits, green - LITERALS)
            code = _extra(bits, group[4].read(bits))
            at = bits.at
            if code > 120:
                back = code - 120
            else:
                x, y = neighbourhood()[code - 1]
                back = max(1, x + y * width)
            if back > n or n + length > total:
                raise ValueError("a back-reference outside the picture")
            if back >= length:
                out += out[n - back : n - back + length]
            else:
                piece = out[n - back :]
                out += (piece * (length // back + 1))[:length]
            n += length
        else:
            remember()
            out.append(held[green - LITERALS - LENGTHS])
            at += used
            n += 1
    bits.at = at
    if at > end:
        raise ValueError("the picture ends too early")
    return np.array(out, np.uint32)


def _literals(bits: Bits, count: int, code: Code) -> np.ndarray:
    """count symbols of one code, all literals."""
    first = bits.at >> 3
    raw = np.frombuffer(bits.data, np.uint8)[first:].astype(np.uint32)
    window = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    lengths, symbols = code.arrays
    mask = np.uint32((1 << code.width) - 1)
    each = np.empty((len(window), 8), np.uint8)
    for j in range(8):
        each[:, j] = lengths[(window >> np.uint32(j)) & mask]
    step, at = each.tobytes(), bits.at & 7
    places = [0] * count
    try:
        for i in range(count):
            places[i] = at
            at += step[at]
    except IndexError:
        raise ValueError("the picture ends too early") from None
    bits.at = (first << 3) + at
    if bits.at > bits.end:
        raise ValueError("the picture ends too early")
    found = np.array(places, np.int64)
    return symbols[(window[found >> 3] >> (found & 7).astype(np.uint32)) & mask]


def _plain(groups: list, cache: int) -> bool:
    """Whether there is one group whose pixels are literals of one code for green, red and blue."""
    if len(groups) != 1 or cache:
        return False
    green, red, blue, alpha, _ = groups[0]
    return not any(green.lengths[LITERALS:]) and green.width > 0 and green.lengths[:LITERALS] == red.lengths == blue.lengths and alpha.only is not None


def _entropy_image(bits: Bits, width: int, height: int) -> np.ndarray:
    cache = _cache_bits(bits)
    return _pixels(bits, width, height, cache, _groups(bits, 1, cache), None, 0).reshape(height, width)


def _parts(pixels: np.ndarray) -> list[np.ndarray]:
    return [(pixels >> np.uint32(s)) & np.uint32(255) for s in (24, 16, 8, 0)]


def _predict(pixels: np.ndarray, modes: np.ndarray, shift: int) -> np.ndarray:
    """Undoes the predictor transform."""
    height, width = pixels.shape
    rest = np.stack(_parts(pixels), -1).astype(int).tolist()
    out = [[None] * width for _ in range(height)]
    half = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b, strict=True)]
    clip = lambda v: 0 if v < 0 else 255 if v > 255 else v
    for y in range(height):
        row, up = out[y], out[y - 1]
        for x in range(width):
            if not y:
                guess = row[x - 1] if x else [255, 0, 0, 0]
            elif not x:
                guess = up[0]
            else:
                left, top, corner = row[x - 1], up[x], up[x - 1]
                right = up[x + 1] if x + 1 < width else row[0]
                mode = modes[y >> shift][x >> shift]
                if mode == 1:
                    guess = left
                elif mode == 2:
                    guess = top
                elif mode == 3:
                    guess = right
                elif mode == 4:
                    guess = corner
                elif mode == 5:
                    guess = half(half(left, right), top)
                elif mode == 6:
                    guess = half(left, corner)
                elif mode == 7:
                    guess = half(left, top)
                elif mode == 8:
                    guess = half(corner, top)
                elif mode == 9:
                    guess = half(top, right)
                elif mode == 10:
                    guess = half(half(left, corner), half(top, right))
                elif mode == 11:
                    to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
                    to_top = sum(abs(a - c) for a, c in zip(left, corner, strict=True))
                    guess = left if to_left < to_top else top
                elif mode == 12:
                    guess = [clip(a + b - c) for a, b, c in zip(left, top, corner, strict=True)]
                elif mode == 13:
                    mean = half(left, top)
                    guess = [clip(m + int((m - c) / 2)) for m, c in zip(mean, corner, strict=True)]
                else:
                    guess = [255, 0, 0, 0]
            row[x] = [(a + b) & 255 for a, b in zip(rest[y][x], guess, strict=True)]
    a, r, g, b = np.moveaxis(np.array(out, np.uint32).reshape(height, width, 4), -1, 0)
    return a << np.uint32(24) | r << np.uint32(16) | g << np.uint32(8) | b


def _blocks_of(image: np.ndarray, shift: int, height: int, width: int) -> np.ndarray:
    return image[np.arange(height)[:, None] >> shift, np.arange(width)[None, :] >> shift]


def _cross(pixels: np.ndarray, elements: np.ndarray, shift: int) -> np.ndarray:
    """Undoes the cross-colour transform."""
    signed = lambda v: v.astype(np.uint8).view(np.int8).astype(np.int64)
    a, r, g, b = (v.astype(np.int64) for v in _parts(pixels))
    _, red_blue, green_blue, green_red = (signed(v) for v in _parts(_blocks_of(elements, shift, *pixels.shape)))
    r = (r + (green_red * signed(g) >> 5)) & 255
    b = (b + (green_blue * signed(g) >> 5) + (red_blue * signed(r) >> 5)) & 255
    return (a << 24 | r << 16 | g << 8 | b).astype(np.uint32)


def _unpalette(pixels: np.ndarray, colours: np.ndarray, width: int, pack: int) -> np.ndarray:
    size = 8 >> pack
    x = np.arange(width)
    index = (_parts(pixels)[2][:, x >> pack] >> ((x & ((1 << pack) - 1)) * size).astype(np.uint32)) & np.uint32((1 << size) - 1)
    return np.append(colours, np.zeros(256, np.uint32))[index]


_seen: dict[int, tuple[bytes, int, int, list]] = {}


def decode(picture: bytes) -> np.ndarray:
    """The picture's pixels, height x width x RGBA."""
    if picture[:4] != b"RIFF" or picture[8:16] != b"WEBPVP8L" or picture[20:21] != b"\x2f":
        raise ValueError("not a lossless WebP picture")
    size = int.from_bytes(picture[16:20], "little")
    if len(picture) < 20 + size:
        raise ValueError("the picture ends too early")
    bits = Bits(picture[21 : 20 + size])
    width, height, _, version = bits.read(14) + 1, bits.read(14) + 1, bits.read(1), bits.read(3)
    if version:
        raise ValueError("an unknown version")
    if known := _seen.get(0):  # a picture of literals that begins with the same codes as the last one
        head, last, mask, groups = known
        n = 4 + len(head)
        if bits.data[4:n] == head and bits.data[n] & mask == last:
            bits.at = n * 8 + mask.bit_length()
            return _finish(_literals(bits, width * height * 3, groups[0][0]), width, height, groups)
    todo, columns = [], width
    while bits.read(1):
        kind = bits.read(2)
        if any(t[0] == kind for t in todo):
            raise ValueError("a transform stands twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            shift = bits.read(3) + 2
            todo.append((kind, shift, _entropy_image(bits, (columns + (1 << shift) - 1) >> shift, (height + (1 << shift) - 1) >> shift)))
        elif kind == SUBTRACT_GREEN:
            todo.append((kind,))
        else:
            n = bits.read(8) + 1
            steps = np.stack(_parts(_entropy_image(bits, n, 1)[0]))
            a, r, g, b = np.cumsum(steps, axis=1).astype(np.uint32) & np.uint32(255)
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            todo.append((kind, a << np.uint32(24) | r << np.uint32(16) | g << np.uint32(8) | b, columns, pack))
            columns = (columns + (1 << pack) - 1) >> pack
    cache, entropy, shift, count = _cache_bits(bits), None, 0, 1
    if bits.read(1):
        shift = bits.read(3) + 2
        entropy = (_entropy_image(bits, (columns + (1 << shift) - 1) >> shift, (height + (1 << shift) - 1) >> shift) >> np.uint32(8)) & np.uint32(0xFFFF)
        count = int(entropy.max()) + 1
    groups = _groups(bits, count, cache)
    if not todo and entropy is None and _plain(groups, cache):
        full, rest = divmod(bits.at, 8)
        mask = (1 << rest) - 1
        _seen[0] = bits.data[4:full], bits.data[full] & mask, mask, groups
        return _finish(_literals(bits, width * height * 3, groups[0][0]), width, height, groups)
    pixels = _pixels(bits, columns, height, cache, groups, entropy, shift).reshape(height, columns)
    for kind, *with_ in reversed(todo):
        if kind == PREDICTOR:
            pixels = _predict(pixels, (_parts(with_[1])[2] & np.uint32(15)).tolist(), with_[0])
        elif kind == CROSS_COLOUR:
            pixels = _cross(pixels, with_[1], with_[0])
        elif kind == SUBTRACT_GREEN:
            a, r, g, b = _parts(pixels)
            pixels = a << np.uint32(24) | ((r + g) & np.uint32(255)) << np.uint32(16) | g << np.uint32(8) | ((b + g) & np.uint32(255))
        else:
            pixels = _unpalette(pixels, with_[0], with_[1], with_[2])
    a, r, g, b = _parts(pixels)
    return np.stack([r, g, b, a], -1).astype(np.uint8)


def _finish(samples: np.ndarray, width: int, height: int, groups: list) -> np.ndarray:
    grb = samples.reshape(height, width, 3)
    return np.dstack([grb[..., 1], grb[..., 0], grb[..., 2], np.full((height, width), groups[0][3].only, np.uint8)])


# ---- writing


def huffman(weights: Sequence[float]) -> list[int]:
    """Code lengths for symbols of these weights (zero: no code)."""
    heap = [(w, s, (s,)) for s, w in enumerate(weights) if w]
    lengths = [0] * len(weights)
    if len(heap) == 1:
        lengths[heap[0][1]] = 1
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in a[2] + b[2]:
            lengths[s] += 1
        heapq.heappush(heap, (a[0] + b[0], min(a[1], b[1]), a[2] + b[2]))
    return lengths


def limited(counts: Sequence[float], most: int) -> list[int]:
    """Code lengths of at most ``most`` bits: rare symbols count more until they fit."""
    counts = [float(c) for c in counts]
    while max(lengths := huffman(counts), default=0) > most:
        least = max(counts) / (1 << most)
        counts = [max(c * 0.5 + 0.5, least) if c else 0.0 for c in counts]
    return lengths


class Writer:
    """Bits to be written, lowest first."""

    def __init__(self) -> None:
        self.bits: list[int] = []

    def put(self, value: int, n: int) -> None:
        self.bits += [value >> k & 1 for k in range(n)]

    def code(self, lengths: Sequence[int]) -> None:
        """A prefix code of these lengths."""
        used = [s for s, n in enumerate(lengths) if n]
        if len(used) <= 2 and all(s < 256 for s in used):
            self.put(1, 1)
            self.put(len(used) == 2, 1)
            self.put(1, 1)
            for s in used or [0]:
                self.put(s, 8)
            return
        if max(lengths) > 15:
            raise ValueError("a prefix code is too deep")
        size, tokens, at = max(used) + 1, [], 0
        while at < size:
            n, run = lengths[at], 1
            while at + run < size and lengths[at + run] == n:
                run += 1
            if not n and run >= 3:
                run = min(run, 138)
                tokens.append((17, run - 3, 3) if run < 11 else (18, run - 11, 7))
            elif n and run >= 4:
                run = min(run, 7)
                tokens += [(n, 0, 0), (16, run - 4, 2)]
            else:
                run = 1
                tokens.append((n, 0, 0))
            at += run
        counts = Counter(t[0] for t in tokens)
        own = limited([counts.get(s, 0) ** 0.8 for s in range(19)], 7)
        if sum(map(bool, own)) < 2:  # one kind of token: give it a partner
            own[0 if not own[0] else 1] = own[max(range(19), key=own.__getitem__)] = 1
        if max(own) > 7:
            raise ValueError("the code-length code is too deep")
        shown = max(4, max(k + 1 for k, s in enumerate(LENGTH_ORDER) if own[s]))
        self.put(0, 1)
        self.put(shown - 4, 4)
        for s in LENGTH_ORDER[:shown]:
            self.put(own[s], 3)
        self.put(1, 1)
        width = next(w for w in range(2, 18, 2) if len(tokens) - 2 < 1 << w)
        self.put((width - 2) // 2, 3)
        self.put(len(tokens) - 2, width)
        words = Code(own).words
        for token, extra, n in tokens:
            self.put(*words[token])
            self.put(extra, n)

    def picture(self, width: int, height: int, samples: np.ndarray | None = None) -> bytes:
        """The file; samples: bits that follow the written ones."""
        head = (width - 1) | (height - 1) << 14
        own = np.array(self.bits, np.uint8)
        body = b"\x2f" + head.to_bytes(4, "little") + np.packbits(own if samples is None else np.concatenate([own, samples]), bitorder="little").tobytes()
        chunk = b"VP8L" + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) % 2)
        return b"RIFF" + (4 + len(chunk)).to_bytes(4, "little") + b"WEBP" + chunk


@functools.cache
def _payload_code() -> tuple[list[int], np.ndarray, np.ndarray]:
    """The fixed code for text bytes: header bits, and for each byte its bits and which of them count."""
    weights = np.full(256, 0.5)
    weights[0x80:0xC0] = 2.0
    weights[0xC3] = 12.0
    weights[list(b"0123456789")] = 1.0
    weights[list(b"!#$%&*|-'\"()")] = 2.5
    for k, c in enumerate(b"enaitrosdhlucmgpvbfzyqwjkx"):
        weights[c] = 120 / (1 + 0.28 * k)
        weights[c - 32] = 3.0
    weights[32], weights[10], weights[0x2C], weights[0x2E] = 190.0, 3.0, 9.0, 9.0
    lengths = huffman(weights.tolist())
    code = Code(lengths)
    w = Writer()
    for bit in (0, 0, 0):  # no transform, no colour cache, one group
        w.put(bit, 1)
    for own in (lengths + [0] * LENGTHS, lengths, lengths, [0] * 255 + [1], [1] + [0] * (DISTANCES - 1)):
        w.code(own)
    bits, used = np.zeros((256, code.width), np.uint8), np.zeros((256, code.width), bool)
    for s, (word, n) in code.words.items():
        bits[s, :n], used[s, :n] = [word >> k & 1 for k in range(n)], True
    return w.bits, bits, used


def pad(text: bytes) -> bytes:
    """text with spaces up to a positive multiple of a row."""
    return text + b" " * (-len(text) % ROW if text else ROW)


# ---- pictures with codes of their own

#: Pixels that a run takes part in, its shortest length, and the share of a picture that runs must cover.
WINDOW, LEAST_RUN, LEAST_COVER = 4, 6, 0.2
LEAST_PIXELS, PALETTE_COLOURS, DEEPEST = 512, 16, 12
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def repeats(pixels: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance): runs of pixels that stand before as well, each at the nearest distance, none overlapping."""
    n = len(pixels) - WINDOW + 1
    if n < 2:
        return []
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h = (h ^ pixels[k : k + n]) * _ODD[k]
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    back = np.zeros(n, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    starts = np.append(0, np.flatnonzero(np.diff(back)) + 1)
    ends = np.append(starts[1:], n)
    out, at = [], 0
    for k in np.flatnonzero(back[starts] > 0).tolist():
        start, distance = max(int(starts[k]), at), int(back[starts[k]])
        end = int(ends[k]) + WINDOW - 1
        # equal hashes could be a coincidence: only equal pixels count
        differ = np.flatnonzero(pixels[start:end] != pixels[start - distance : end - distance])
        length = (int(differ[0]) if len(differ) else end - start) if end > start else 0
        if length >= LEAST_RUN and distance <= (1 << 20) - 120:
            out += [(start + lo, min(4096, length - lo), distance) for lo in range(0, length, 4096)]
            at = start + length
    return out


def _prefixed(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol, extra bits and their number of lengths or distance codes (1 or more)."""
    rest = np.asarray(value, np.int64) - 1
    high = np.frexp(np.maximum(rest, 1))[1] - 1
    extra = np.maximum(high - 1, 0)
    symbol = np.where(rest < 4, rest, 2 * high + ((rest >> extra) & 1))
    few = rest < 4
    return symbol, np.where(few, 0, rest & ((1 << extra) - 1)), np.where(few, 0, extra)


def _hits(pixels: np.ndarray, cache: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each pixel stands in the colour cache when its turn comes, and its place there."""
    slot = ((pixels.astype(np.uint64) * np.uint64(0x1E35A7BD)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - cache)
    order = np.argsort(slot, kind="stable")
    hit = np.zeros(len(pixels), bool)
    hit[order[1:]] = (slot[order[1:]] == slot[order[:-1]]) & (pixels[order[1:]] == pixels[order[:-1]])
    return hit, slot.astype(np.int64)


def _coded(pixels: np.ndarray, width: int, runs: list[tuple[int, int, int]], cache: int, *, main: bool) -> tuple[Writer, np.ndarray]:
    """The codes of an image (as a writer's bits) and the bits of its pixels."""
    start, length, distance = (np.array([r[k] for r in runs], np.int64) for k in range(3))
    alone = np.ones(len(pixels), bool)
    alone[np.arange(int(length.sum())) + np.repeat(start - np.cumsum(length) + length, length)] = False
    literal = np.flatnonzero(alone)
    hit = np.zeros(len(literal), bool)
    if cache:
        every, slot = _hits(pixels, cache)
        hit = every[literal]
    size, extra, extra_bits = _prefixed(length)
    near = {max(1, x + y * width): k + 1 for k, (x, y) in reversed(list(enumerate(neighbourhood())))}
    place, far, far_bits = _prefixed(np.array([near.get(d, d + 120) for d in distance.tolist()], np.int64))
    argb = [(pixels[literal] >> np.uint32(s) & np.uint32(255)).astype(np.int64) for s in (24, 16, 8, 0)]
    green = argb[2].copy()
    if cache:
        green[hit] = LITERALS + LENGTHS + slot[literal[hit]]
    counts = [np.bincount(np.append(green, LITERALS + size), minlength=LITERALS + LENGTHS + ((1 << cache) if cache else 0))]
    counts += [np.bincount(argb[k][~hit], minlength=LITERALS) for k in (1, 3, 0)]
    counts.append(np.bincount(place, minlength=DISTANCES))
    w, words = Writer(), []
    w.put(cache > 0, 1)
    if cache:
        w.put(cache, 4)
    if main:
        w.put(0, 1)
    for own in counts:
        lengths = limited(own.tolist(), DEEPEST)
        w.code(lengths)
        code = Code(lengths)
        table = np.zeros((len(own), 2), np.int64)
        if code.only is None:
            table[list(code.words)] = list(code.words.values())
        words.append(table)
    # each token has four fields: value and number of bits
    fields = np.zeros((len(literal) + len(runs), 4, 2), np.int64)
    order = np.argsort(np.append(literal, start), kind="stable")
    tokens = np.zeros_like(fields)
    tokens[: len(literal), 0] = words[0][green]
    for k, channel in ((1, 1), (2, 3), (3, 0)):
        tokens[: len(literal), k][~hit] = words[k][argb[channel][~hit]]
    tokens[len(literal) :, 0] = words[0][LITERALS + size]
    tokens[len(literal) :, 1] = np.stack([extra, extra_bits], 1)
    tokens[len(literal) :, 2] = words[4][place]
    tokens[len(literal) :, 3] = np.stack([far, far_bits], 1)
    fields = tokens[order].reshape(-1, 2)
    value, bits = fields[fields[:, 1] > 0].T
    ends = np.cumsum(bits)
    which = np.repeat(np.arange(len(bits)), bits)
    body = (value[which] >> (np.arange(len(which)) - np.repeat(ends - bits, bits))) & 1
    return w, body.astype(np.uint8)


def _own_codes(pixels: np.ndarray, height: int) -> bytes | None:
    """A picture with codes of its own, if runs or few colours make that worth while."""
    if len(pixels) < LEAST_PIXELS:
        return None
    forms = []
    colours = np.unique(pixels) if len(np.unique(pixels[:256])) <= PALETTE_COLOURS else np.zeros(PALETTE_COLOURS + 1)
    if len(colours) <= PALETTE_COLOURS:
        pack = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1
        index = np.searchsorted(colours, pixels).reshape(height, -1, 1 << pack)
        bundled = (index << (np.arange(1 << pack) * (8 >> pack))).sum(2).astype(np.uint32).ravel()
        parts = np.stack([np.diff(colours >> np.uint32(s) & np.uint32(255), prepend=np.uint32(0)) & np.uint32(255) for s in (24, 16, 8, 0)])
        deltas = parts[0] << np.uint32(24) | parts[1] << np.uint32(16) | parts[2] << np.uint32(8) | parts[3]
        head, body = _coded(deltas, len(colours), [], 0, main=False)
        forms.append(([1, 1, 1, *[len(colours) - 1 >> k & 1 for k in range(8)], *head.bits, *body.tolist(), 0], np.uint32(0xFF000000) | bundled << np.uint32(8), COLUMNS >> pack, (0,)))
    runs = repeats(pixels)
    if sum(r[1] for r in runs) >= LEAST_COVER * len(pixels):
        forms.append(([0], pixels, COLUMNS, (0, min(10, len(pixels).bit_length() - 3))))
    best = None
    for before, image, width, caches in forms:
        found = runs if image is pixels else repeats(image)
        for cache in caches:
            head, body = _coded(image, width, found, cache, main=True)
            if best is None or len(before) + len(head.bits) + len(body) < sum(map(len, best)):
                best = before + head.bits, body
    if best is None:
        return None
    w = Writer()
    w.bits = best[0]
    return w.picture(COLUMNS, height, best[1])


def store(payload: bytes) -> bytes:
    """Pictures of a payload whose length is a multiple of ROW."""
    head, bits, used = _payload_code()
    out = []
    for lo in range(0, len(payload), ROW * MOST_ROWS):
        rgb = np.frombuffer(payload, np.uint8)[lo : lo + ROW * MOST_ROWS].reshape(-1, 3)
        wide = rgb.astype(np.uint32)
        own = _own_codes(np.uint32(0xFF000000) | wide[:, 0] << np.uint32(16) | wide[:, 1] << np.uint32(8) | wide[:, 2], len(rgb) // COLUMNS)
        flow = rgb[:, [1, 0, 2]].ravel()
        w = Writer()
        w.bits = head
        plain = w.picture(COLUMNS, len(rgb) // COLUMNS, bits[flow][used[flow]])
        out.append(plain if own is None or len(own) >= len(plain) else own)
    return b"".join(out)


def pictures(media: bytes) -> list[bytes]:
    """The files that stand one after the other."""
    out, at = [], 0
    while at < len(media):
        size = 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        out.append(media[at : at + size])
        at += size
    return out


def decode_column(df: DataFrame, column: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """The columns in keep, and width, height and pixels (RGBA bytes, row by row) of the pictures in a binary column.

    A column in keep that is named like one of these is left out.
    """
    keep = [k for k in keep if k not in ("width", "height", "pixels")]
    chosen = df.select(F.col(column), *keep).toDF("__picture", *[f"__k{i}" for i in range(len(keep))])

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "__picture")):
            arrays = [None if p is None else decode(p) for p in batch.column("__picture").to_pylist()]
            size = lambda k: pa.array([None if a is None else a.shape[k] for a in arrays], pa.int32())
            kept = {n: batch.column(n) for n in batch.schema.names if n != "__picture"}
            yield arrays_batch(kept | {"width": size(1), "height": size(0), "pixels": pa.array([None if a is None else a.tobytes() for a in arrays], pa.binary())})

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__picture"]
    return chosen.mapInArrow(run, ", ".join([*schema, "width int, height int, pixels binary"])).toDF(*keep, "width", "height", "pixels")


def store_column(df: DataFrame, column: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """The columns in keep, and for a text column what was stored and read back: sizes, digests, features and the media.

    A column in keep that is named like one of these is left out.
    """
    names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
    keep = [k for k in keep if k not in names]
    chosen = df.select(F.col(column), *keep).toDF("__text", *[f"__k{i}" for i in range(len(keep))])

    def row(text: bytes | None) -> tuple:
        text = text or b""
        media = store(pad(text))
        arrays = [decode(p) for p in pictures(media)]
        back = b"".join(a[..., :3].tobytes() for a in arrays)
        rgb = np.frombuffer(back, np.uint8).reshape(-1, 3)
        sums = rgb.sum(0, dtype=np.int64).tolist()
        values = int(np.count_nonzero(np.bincount(rgb.ravel(), minlength=256)))
        feature = f"{COLUMNS}x{len(rgb) // COLUMNS};pictures={len(arrays)};sums={sums[0]},{sums[1]},{sums[2]};values={values}"
        return len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature, media

    def run(batches):
        for batch in (p for b in batches for p in portions(b, "__text")):
            rows = list(zip(*map(row, batch.column("__text").cast(pa.binary()).to_pylist()), strict=True))
            yield arrays_batch({n: batch.column(n) for n in batch.schema.names if n != "__text"} | {n: pa.array(v, k) for n, k, v in zip(names, kinds, rows, strict=True)})

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "__text"]
    made = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, media binary"
    return chosen.mapInArrow(run, ", ".join([*schema, made])).toDF(*keep, *names)


def op6_webp_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_column(table(spark, sf_dir, "documents"), "text", keep=("doc_id",)).drop("media")


QUERIES = {"op6_webp_media": op6_webp_media}
