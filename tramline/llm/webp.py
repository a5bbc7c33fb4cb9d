"""Lossless WebP columns: a writer, and a reader that decodes many images in step.

The reader follows the public bitstream: canonical prefix codes in groups, literals, back-references and colour
cache, and the inverse of the predictor, cross-colour, subtract-green and palette transforms. Images are lanes of numpy
arrays: each step decodes one token of every image, so that the cost of Python is shared by all of them."""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: An image holds at most WIDTH x ROWS pixels of four samples; longer payloads are a sequence of images.
WIDTH, ROWS = 16, 256
#: Longest prefix code written, bits of the colour cache, least pixels of a back-reference.
LIMIT, CACHE, MATCH = 11, 7, 4
#: Images decoded in step; the most whose codes are long.
LANES, LONG_LANES = 1024, 32
#: The order in which lengths of the code-length code are stored, and the cache's multiplier.
ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
MULTIPLIER = 0x1E35A7BD
#: Near distances (x, y) by code: nearest first, then smaller |x|, right before left.
NEAR = sorted([(x, y) for y in range(8) for x in range(-7, 9) if y or x > 0], key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))[:120]


class Corrupt(ValueError):
    pass


@lru_cache(16)
def reversed_bits(n: int) -> np.ndarray:
    x = np.arange(1 << n)
    out = np.zeros_like(x)
    for _ in range(n):
        out, x = out << 1 | x & 1, x >> 1
    return out


# --- writing ---


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of a complete prefix code: near -log2 of the shares, then shortened from the commonest until the code
    is complete. One symbol alone has length 0; give at least one."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        return out
    used = used[np.argsort(-counts[used], kind="stable")]
    c = counts[used]
    n = np.clip(np.ceil(np.log2(c.sum() / c)), 1, limit).astype(np.int64)
    over = int((1 << (limit - n)).sum()) - (1 << limit)
    i = len(n) - 1
    while over > 0:  # the limit shortened rare ones: lengthen from the rarest that can be
        if n[i] < limit:
            over -= 1 << (limit - n[i] - 1)
            n[i] += 1
        else:
            i -= 1
    room = -over
    while room:
        for at in range(len(n)):
            gain = 1 << int(limit - n[at])
            if gain <= room and n[at] > 1:
                n[at] -= 1
                room -= gain
            if not room:
                break
    out[used] = n
    return out


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes, as their bits go into the stream."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    n = lengths[order]
    out = np.zeros(len(lengths), np.int64)
    if len(order):
        top = int(n.max())
        starts = np.cumsum(1 << (top - n)) - (1 << (top - n))
        out[order] = reversed_bits(top)[starts]  # the code's bits lead, so reversed they come first
    return out


class Writer:
    def __init__(self):
        self.values, self.sizes = [], []

    def put(self, value, size):
        """Numbers or arrays of at most 22 bits each."""
        self.values.append(np.atleast_1d(np.asarray(value, np.int64)))
        self.sizes.append(np.atleast_1d(np.asarray(size, np.int64)))

    def bytes(self) -> bytes:
        v, n = np.concatenate(self.values), np.concatenate(self.sizes)
        ends = np.cumsum(n)
        start = ends - n
        x, word, words = v << (start & 31), start >> 5, (int(ends[-1]) >> 5) + 2
        low = np.bincount(word, weights=x & 0xFFFFFFFF, minlength=words)
        high = np.bincount(word + 1, weights=x >> 32, minlength=words)
        return (low[:words].astype(np.uint64) + high[:words].astype(np.uint64)).astype("<u4").tobytes()[: (int(ends[-1]) + 7) // 8]


def _write_code(out: Writer, lengths: np.ndarray, only: int) -> None:
    used = np.flatnonzero(lengths)
    if len(used) == 0 and only < 256:
        out.put([1, 0, 1, only], [1, 1, 1, 8])
        return
    if len(used) == 2 and used[1] < 256:
        out.put([1, 1, 1, used[0], used[1]], [1, 1, 1, 8, 8])
        return
    if len(used) == 0:  # one symbol past 255: a second of no use completes the code
        lengths = lengths.copy()
        lengths[[0, only]] = 1
        used = np.flatnonzero(lengths)
    plain = [0] * 19
    plain[:16] = [4] * 16
    out.put([0, 15], [1, 4])
    out.put([plain[i] for i in ORDER], [3] * 19)
    top = max(2, int(used[-1]) + 1)
    bits = max(2, (top - 2).bit_length() + (top - 2).bit_length() % 2)
    out.put([1, (bits - 2) // 2, top - 2], [1, 3, bits])
    out.put(reversed_bits(4)[lengths[:top]], np.full(top, 4))


def prefix(v: np.ndarray):
    """Symbol, extra bits and their value of lengths and distances from 1."""
    d = np.maximum(v - 1, 1)
    high = np.floor(np.log2(d)).astype(np.int64)
    small = v <= 4
    symbol = np.where(small, v - 1, 2 * high + ((d >> np.maximum(high - 1, 0)) & 1))
    bits = np.where(small, 0, high - 1)
    return symbol, bits, np.where(small, 0, d & ((1 << bits) - 1))


def copies(px: np.ndarray, least: int = MATCH) -> list[tuple[int, int, int]]:
    """(start, length, distance) of repeats, greedily: each place looks at the last one with the same four pixels."""
    n = len(px) - least + 1
    if n < 2:
        return []
    wide = px.astype(np.uint64)
    h = wide[:n].copy()
    for i in range(1, least):
        h = h * np.uint64(0x9E3779B97F4A7C15) + wide[i : n + i]
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return []
    back = np.full(n, -1, np.int64)
    back[order[same + 1]] = order[same]
    found, end = [], 0
    for i in np.flatnonzero(back >= 0).tolist():
        if i < end:
            continue
        j = int(back[i])
        differ = np.flatnonzero(px[i:] != px[j : len(px) - (i - j)])
        size = min(int(differ[0]) if len(differ) else len(px) - i, 4096)
        if size >= least:
            found.append((i, size, i - j))
            end = i + size
    return found


def cache_keys(px: np.ndarray, bits: int) -> np.ndarray:
    return ((px.astype(np.uint64) * np.uint64(MULTIPLIER) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits)).astype(np.int64)


def _write_image(out: Writer, px: np.ndarray, top: bool, cache: int = 0, repeats: bool = True) -> None:
    """An entropy-coded image: cache, one code group, and its tokens."""
    n = len(px)
    out.put([1, cache] if cache else [0], [1, 4] if cache else [1])
    if top:
        out.put(0, 1)
    runs = copies(px) if repeats else []
    literal = np.ones(n, bool)
    for at, size, _ in runs:
        literal[at : at + size] = False
    a, r, g, b = ((px >> np.uint32(s) & np.uint32(255)).astype(np.int64) for s in (24, 16, 8, 0))
    hit = np.zeros(n, bool)
    if cache:
        key = cache_keys(px, cache)
        order = np.argsort(key, kind="stable")
        was = (key[order[1:]] == key[order[:-1]]) & (px[order[1:]] == px[order[:-1]])
        hit[order[1:][was]] = True
        hit &= literal
        literal &= ~hit
    green = np.where(hit, 280 + key, g) if cache else g.copy()
    size_alphabet = 280 + ((1 << cache) if cache else 0)
    at = np.array([x[0] for x in runs], np.int64)
    ls, lb, lv = prefix(np.array([x[1] for x in runs], np.int64))
    ds, db, dv = prefix(np.array([x[2] for x in runs], np.int64) + 120)
    green[at] = 256 + ls
    token = literal | hit
    token[at] = True
    alphabets = [(np.bincount(green[token], minlength=size_alphabet)), *[np.bincount(c[literal], minlength=256) for c in (r, b, a)], np.bincount(ds, minlength=40)]
    lengths = [code_lengths(c) for c in alphabets]
    for c, n_ in zip(alphabets, lengths, strict=True):
        _write_code(out, n_, int(np.argmax(c)))
    stored = []
    for c, n_ in zip(alphabets, lengths, strict=True):
        if not n_.any() and (only := int(np.argmax(c))) > 255:
            n_ = n_.copy()
            n_[[0, only]] = 1
        stored.append((codes_of(n_), n_))
    (cg, ng), (cr, nr), (cb, nb), (ca, na), (cd, nd) = stored
    first, size1 = cg[green], ng[green]
    second, size2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
    i = literal
    first[i] |= cr[r[i]] << size1[i]
    size1[i] += nr[r[i]]
    second[i] = cb[b[i]] | ca[a[i]] << nb[b[i]]
    size2[i] = nb[b[i]] + na[a[i]]
    if len(at):
        first[at] |= lv << size1[at]
        size1[at] += lb
        second[at] = cd[ds] | dv << nd[ds]
        size2[at] = nd[ds] + db
    out.put(np.stack([first[token], second[token]], 1).ravel(), np.stack([size1[token], size2[token]], 1).ravel())


def encode(px: np.ndarray, width: int, steps=None, cache: int | None = None) -> bytes:
    """A WebP file of the ARGB pixels (uint32, rows of `width`). `steps`: transforms to apply, in order: "green",
    ("predict", bits, modes), ("cross", bits, elements), "palette"; by itself the writer takes a palette for at most
    16 colours, and the cache where pixels repeat."""
    px = np.ascontiguousarray(px, np.uint32)
    height, out = len(px) // width, Writer()
    out.put([0x2F, width - 1, height - 1, 1, 0], [8, 14, 14, 1, 3])
    if steps is None:
        steps = ["palette"] if len(px) <= 4096 and len(np.unique(px)) <= 16 else []
    for step in steps:
        if step == "green":
            out.put([1, 2], [1, 2])
            g = px >> np.uint32(8) & np.uint32(255)
            px = px & np.uint32(0xFF00FF00) | ((px >> np.uint32(16)) - g & np.uint32(255)) << np.uint32(16) | (px - g & np.uint32(255))
        elif step == "palette":
            colours, at = np.unique(px, return_inverse=True)
            out.put([1, 3, len(colours) - 1], [1, 2, 8])
            _write_image(out, _subtract(colours, np.r_[np.uint32(0), colours[:-1]]), False, repeats=False)
            bits = 3 if len(colours) <= 2 else 2 if len(colours) <= 4 else 1 if len(colours) <= 16 else 0
            per, size = 1 << bits, 8 >> bits
            at = np.pad(at.reshape(height, width), ((0, 0), (0, -width % per))).reshape(height, -1, per)
            px = (0xFF000000 | (at << (np.arange(per) * size)).sum(2) << 8).astype(np.uint32).ravel()
            width = -(-width // per)
        else:
            kind, bits, table = step
            out.put([1, 0 if kind == "predict" else 1, bits - 2], [1, 2, 3])
            table = np.asarray(table, np.uint32)
            _write_image(out, table, False, repeats=False)
            px = _predict(px, width, bits, table, -1) if kind == "predict" else _cross(px, width, bits, table, -1)
    out.put(0, 1)
    if cache is None:
        cache = CACHE if len(px) >= 64 and len(np.unique(px)) < 0.9 * len(px) else 0
    _write_image(out, px, True, cache)
    data = out.bytes()
    body = b"WEBPVP8L" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


# --- transforms ---


def _channels(px):
    return [(px >> np.uint32(s) & np.uint32(255)).astype(np.int64) for s in (24, 16, 8, 0)]


def _joined(a, r, g, b):
    return ((a & 255) << 24 | (r & 255) << 16 | (g & 255) << 8 | b & 255).astype(np.uint32)


def _subtract(x, y):
    return _joined(*[a - b for a, b in zip(_channels(x), _channels(y), strict=True)])


def _blocks(table, width, height, bits):
    """The table's element for each pixel."""
    per = (width + (1 << bits) - 1) >> bits
    y, x = np.divmod(np.arange(width * height), width)
    return table[(y >> bits) * per + (x >> bits)]


def _cross(px, width, bits, table, sign):
    """sign 1 inverts the colour transform, -1 applies it."""
    _, red_blue, green_blue, green_red = [((c + 128) & 255) - 128 for c in _channels(_blocks(table, width, len(px) // width, bits))]
    a, r, g, b = _channels(px)
    s = lambda c: ((c + 128) & 255) - 128
    red = r + sign * (green_red * s(g) >> 5)
    b = b + sign * (green_blue * s(g) >> 5) + sign * (red_blue * s(red if sign > 0 else r) >> 5)
    return _joined(a, red, g, b)


def _predict(px, width, bits, table, sign):
    """sign 1 inverts the predictor transform, -1 applies it. Pixels depend on earlier ones, so this is a loop."""
    height = len(px) // width
    mode = (_blocks(table, width, height, bits) >> np.uint32(8) & np.uint32(15)).tolist()
    given = [((p >> 24) & 255, (p >> 16) & 255, (p >> 8) & 255, p & 255) for p in px.tolist()]
    out = list(given) if sign < 0 else [None] * len(given)
    black = (255, 0, 0, 0)
    mean = lambda x, y: tuple((p + q) >> 1 for p, q in zip(x, y))
    clamp = lambda v: max(0, min(255, v))
    result = []
    for i, p in enumerate(given):
        y, x = divmod(i, width)
        if not i:
            guess = black
        elif not y:
            guess = out[i - 1]
        elif not x:
            guess = out[i - width]
        else:
            left, up, corner, right = out[i - 1], out[i - width], out[i - width - 1], out[i - width + 1]
            m = mode[i]
            if m == 1:
                guess = left
            elif m == 2:
                guess = up
            elif m == 3:
                guess = right
            elif m == 4:
                guess = corner
            elif m == 5:
                guess = mean(mean(left, right), up)
            elif m == 6:
                guess = mean(left, corner)
            elif m == 7:
                guess = mean(left, up)
            elif m == 8:
                guess = mean(corner, up)
            elif m == 9:
                guess = mean(up, right)
            elif m == 10:
                guess = mean(mean(left, corner), mean(up, right))
            elif m == 11:
                to_left = sum(abs(u - c) for u, c in zip(up, corner))
                to_up = sum(abs(v - c) for v, c in zip(left, corner))
                guess = left if to_left < to_up else up
            elif m == 12:
                guess = tuple(clamp(v + u - c) for v, u, c in zip(left, up, corner))
            elif m == 13:
                guess = tuple(clamp(v + int((v - c) / 2)) for v, c in zip(mean(left, up), corner))
            else:
                guess = black
        value = tuple((q + sign * g) & 255 for q, g in zip(p, guess))
        if sign > 0:
            out[i] = value
        result.append(value)
    return _joined(*np.array(result, np.int64).T)


# --- reading ---


class Lanes:
    """The streams of many images, each with its own place."""

    def __init__(self, files: list[bytes]):
        starts, at = [], 0
        for f in files:
            if f[:4] != b"RIFF" or f[8:16] != b"WEBPVP8L":
                raise Corrupt("not a lossless WebP file")
            starts.append((at + 20) * 8)
            at += len(f)
        data = np.frombuffer(b"".join(files) + bytes(16), np.uint8)
        self.window = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view("<u8")[:, 0]
        self.at = np.array(starts, np.int64)
        self.end = at * 8

    def peek(self, lanes):
        p = self.at[lanes]
        if len(p) and p.max() > self.end:
            raise Corrupt("the stream is cut short")
        return self.window[p >> 3] >> (p & 7).astype(np.uint64)

    def read(self, lanes, n):
        """The next n bits (a number or one for each lane, up to 32)."""
        n = np.broadcast_to(np.asarray(n, np.int64), len(lanes))
        v = self.peek(lanes) & ((np.uint64(1) << n.astype(np.uint64)) - np.uint64(1))
        self.at[lanes] += n
        return v.astype(np.int64)


def tables(lengths: np.ndarray, only: np.ndarray) -> tuple[np.ndarray, int]:
    """For each row of code lengths, symbol << 4 | length for the next bits; rows with one symbol take no bits."""
    single = only >= 0
    top = max(1, int(lengths.max(initial=0)))
    key = np.where(lengths > 0, lengths, 99)
    order = np.argsort(key, axis=1, kind="stable")
    n = np.take_along_axis(lengths, order, 1)
    reps = np.where(n > 0, 1 << (top - n), 0)
    reps[single] = 0
    reps[single, 0] = 1 << top
    order[single, 0], n[single, 0] = only[single], 0
    if (reps.sum(1) != 1 << top).any():
        raise Corrupt("a prefix code isn't complete")
    flat = np.repeat((order << 4 | n).ravel().astype(np.uint32), reps.ravel()).reshape(len(lengths), -1)
    return np.ascontiguousarray(flat[:, reversed_bits(top)]), top


def _read_codes(s: Lanes, lanes: np.ndarray, alphabet: np.ndarray):
    """(lengths, only) of one prefix code for each lane."""
    k, most = len(lanes), int(alphabet.max())
    lengths, only = np.zeros((k, most), np.int64), np.full(k, -1)
    simple = s.read(lanes, 1) == 1
    i = np.flatnonzero(simple)
    if len(i):
        two = s.read(lanes[i], 1) == 1
        wide = s.read(lanes[i], 1) * 7 + 1
        a = s.read(lanes[i], wide)
        only[i] = a
        j = i[two]
        b = s.read(lanes[j], 8)
        same = a[two] == b
        only[j[~same]] = -1
        lengths[j[~same], a[two][~same]] = 1
        lengths[j[~same], b[~same]] = 1
    i = np.flatnonzero(~simple)
    if len(i):
        own = lanes[i]
        count = 4 + s.read(own, 4)
        inner = np.zeros((len(i), 19), np.int64)
        for c in range(int(count.max())):
            j = np.flatnonzero(count > c)
            inner[j, ORDER[c]] = s.read(own[j], 3)
        one = (inner > 0).sum(1) == 1
        lut, top = tables(inner, np.where(one, inner.argmax(1), -1))
        limited = s.read(own, 1) == 1
        left = alphabet[i].copy()
        j = np.flatnonzero(limited)
        left[j] = 2 + s.read(own[j], 2 + 2 * s.read(own[j], 3))
        at, last = np.zeros(len(i), np.int64), np.full(len(i), 8)
        mask = np.uint64((1 << top) - 1)
        while len(j := np.flatnonzero((at < alphabet[i]) & (left > 0))):
            left[j] -= 1
            e = lut[j, (s.peek(own[j]) & mask).astype(np.int64)].astype(np.int64)
            s.at[own[j]] += e & 15
            symbol = e >> 4
            plain = symbol < 16
            p = j[plain]
            lengths[i[p], at[p]] = symbol[plain]
            last[p] = np.where(symbol[plain] > 0, symbol[plain], last[p])
            at[p] += 1
            q, symbol = j[~plain], symbol[~plain]
            if len(q):
                run = s.read(own[q], np.array([2, 3, 7])[symbol - 16]) + np.array([3, 3, 11])[symbol - 16]
                value = np.where(symbol == 16, last[q], 0)
                if (at[q] + run > alphabet[i][q]).any():
                    raise Corrupt("a run of code lengths is too long")
                for lane, a, r, v in zip(q.tolist(), at[q].tolist(), run.tolist(), value.tolist(), strict=True):
                    lengths[i[lane], a : a + r] = v
                at[q] += run
        alone = (lengths[i] > 0).sum(1) == 1
        only[i] = np.where(alone, lengths[i].argmax(1), -1)
        empty = (lengths[i] > 0).sum(1) == 0
        only[i[empty]] = 0
    return lengths, only


def _prefixed(s: Lanes, lane: int, symbol: int) -> int:
    if symbol < 4:
        return symbol + 1
    bits = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << bits) + int(s.read(np.array([lane]), bits)[0]) + 1


def _read_image(s: Lanes, lanes: np.ndarray, width: np.ndarray, height: np.ndarray, top: bool) -> list[np.ndarray]:
    """The pixels of an entropy-coded image for each lane."""
    k, n = len(lanes), width * height
    cached = s.read(lanes, 1) == 1
    bits = np.zeros(k, np.int64)
    bits[cached] = s.read(lanes[cached], 4)
    if (cached & ((bits < 1) | (bits > 11))).any():
        raise Corrupt("a colour cache has an impossible size")
    groups, meta, meta_bits = np.ones(k, np.int64), [None] * k, np.zeros(k, np.int64)
    if top:
        i = np.flatnonzero(s.read(lanes, 1) == 1)
        if len(i):
            meta_bits[i] = 2 + s.read(lanes[i], 3)
            mw, mh = ((d[i] + (1 << meta_bits[i]) - 1) >> meta_bits[i] for d in (width, height))
            for lane, px in zip(i.tolist(), _read_image(s, lanes[i], mw, mh, False), strict=True):
                meta[lane] = (px >> np.uint32(8) & np.uint32(0xFFFF)).astype(np.int64)
                groups[lane] = int(meta[lane].max()) + 1
    base = np.cumsum(groups) - groups
    alphabet = 280 + np.where(cached, 1 << bits, 0)
    most = int(alphabet.max())
    lens = [np.zeros((int(groups.sum()), m), np.int64) for m in (most, 256, 256, 256, 40)]
    only = [np.zeros(int(groups.sum()), np.int64) for _ in range(5)]
    for g in range(int(groups.max())):
        i = np.flatnonzero(groups > g)
        for c, m in enumerate((None, 256, 256, 256, 40)):
            got, one = _read_codes(s, lanes[i], alphabet[i] if m is None else np.full(len(i), m))
            lens[c][base[i] + g, : got.shape[1]] = got
            only[c][base[i] + g] = one
    if k > LONG_LANES and max(int(x.max()) for x in lens) > LIMIT + 1:
        raise OverflowError  # tables of long codes are large: fewer lanes
    (lg, tg), (lr, tr), (lb, tb), (la, ta), (ld, td) = (tables(x, o) for x, o in zip(lens, only, strict=True))
    mg, mr, mb, ma = (np.uint64((1 << t) - 1) for t in (tg, tr, tb, ta))
    out = np.zeros((k, int(n.max())), np.uint32)
    cache = np.zeros((k, 1 << int(bits.max())), np.uint32) if cached.any() else None
    at, row = np.zeros(k, np.int64), base.copy()
    live = np.flatnonzero(n > 0)
    grouped = groups.max() > 1
    while len(live):
        if grouped:
            for lane in live.tolist():
                if meta[lane] is not None:
                    y, x = divmod(int(at[lane]), int(width[lane]))
                    mbits = int(meta_bits[lane])
                    row[lane] = base[lane] + meta[lane][(y >> mbits) * ((int(width[lane]) + (1 << mbits) - 1) >> mbits) + (x >> mbits)]
        own, r = lanes[live], row[live]
        w = s.peek(own)
        e = lg[r, (w & mg).astype(np.int64)]
        size = e & 15
        symbol = (e >> 4).astype(np.int64)
        w >>= size.astype(np.uint64)
        lit = symbol < 256
        all_lit = lit.all()
        some, srow = (live, r) if all_lit else (live[lit], r[lit])
        w, g, used = (w, symbol, size) if all_lit else (w[lit], symbol[lit], size[lit])
        e = lr[srow, (w & mr).astype(np.int64)]
        red, used = e >> 4, used + (e & 15)
        s.at[own if all_lit else own[lit]] += used
        w = s.peek(own if all_lit else own[lit])
        e = lb[srow, (w & mb).astype(np.int64)]
        blue, used = e >> 4, e & 15
        w >>= used.astype(np.uint64)
        e = la[srow, (w & ma).astype(np.int64)]
        s.at[own if all_lit else own[lit]] += used + (e & 15)
        px = (e >> 4) << np.uint32(24) | red << np.uint32(16) | g.astype(np.uint32) << np.uint32(8) | blue
        out[some, at[some]] = px
        if cache is not None:
            c = cached[some]
            cache[some[c], ((px[c].astype(np.uint64) * np.uint64(MULTIPLIER) & np.uint64(0xFFFFFFFF)) >> (32 - bits[some[c]]).astype(np.uint64)).astype(np.int64)] = px[c]
        at[some] += 1
        if not all_lit:
            s.at[own[~lit]] += size[~lit]
            hit = symbol >= 280
            some = live[hit]
            if len(some):
                index = symbol[hit] - 280
                out[some, at[some]] = cache[some, index]
                at[some] += 1
            for lane, sym in zip(live[~lit & ~hit].tolist(), (symbol[~lit & ~hit] - 256).tolist(), strict=True):
                stream = int(lanes[lane])
                length = _prefixed(s, stream, sym)
                e = int(ld[row[lane], int(s.peek(np.array([stream]))[0]) & ((1 << td) - 1)])
                s.at[stream] += e & 15
                code = _prefixed(s, stream, e >> 4)
                dist = code - 120 if code > 120 else max(1, NEAR[code - 1][0] + NEAR[code - 1][1] * int(width[lane]))
                p = int(at[lane])
                if dist > p or p + length > n[lane]:
                    raise Corrupt("a back-reference leaves the image")
                src = out[lane, p - dist : p]
                out[lane, p : p + length] = src[:length] if dist >= length else np.resize(src, length)
                if cache is not None and cached[lane]:
                    px = out[lane, p : p + length]
                    for key, value in zip(cache_keys(px, int(bits[lane])).tolist(), px.tolist(), strict=True):
                        cache[lane, key] = value
                at[lane] = p + length
        live = live[at[live] < n[live]]
    return [out[i, : n[i]].copy() for i in range(k)]


def decode(files: list[bytes]) -> list[tuple[int, int, np.ndarray]]:
    """(width, height, ARGB pixels) of each file. Raises Corrupt."""
    if not files:
        return []
    try:
        return _decode(files)
    except OverflowError:
        half = max(LONG_LANES, len(files) // 2)
        return [x for lo in range(0, len(files), half) for x in decode(files[lo : lo + half])]


def _decode(files):
    s, lanes = Lanes(files), np.arange(len(files))
    if (s.read(lanes, 8) != 0x2F).any():
        raise Corrupt("no signature")
    width, height = s.read(lanes, 14) + 1, s.read(lanes, 14) + 1
    s.read(lanes, 1)
    if s.read(lanes, 3).any():
        raise Corrupt("an unknown version")
    inner, steps = width.copy(), [[] for _ in files]
    more = lanes
    while True:
        more = more[s.read(more, 1) == 1]
        if not len(more):
            break
        kind = s.read(more, 2)
        for t in range(4):
            i = more[kind == t]
            if not len(i):
                continue
            if t == 2:
                for lane in i:
                    steps[lane].append((2, int(inner[lane]), 0, None))
                continue
            if t == 3:
                size = s.read(i, 8) + 1
                for lane, px in zip(i, _read_image(s, i, size, np.ones_like(size), False), strict=True):
                    total = _joined(*[np.cumsum(c) for c in _channels(px)])
                    bits = 3 if len(px) <= 2 else 2 if len(px) <= 4 else 1 if len(px) <= 16 else 0
                    steps[lane].append((3, int(inner[lane]), bits, total))
                    inner[lane] = -(-int(inner[lane]) // (1 << bits))
                continue
            bits = s.read(i, 3) + 2
            mw, mh = (inner[i] + (1 << bits) - 1) >> bits, (height[i] + (1 << bits) - 1) >> bits
            for lane, b, px in zip(i, bits, _read_image(s, i, mw, mh, False), strict=True):
                steps[lane].append((t, int(inner[lane]), int(b), px))
    out = []
    for lane, px in enumerate(_read_image(s, lanes, inner, height, True)):
        for t, w, bits, table in reversed(steps[lane]):
            if t == 0:
                px = _predict(px, w, bits, table, 1)
            elif t == 1:
                px = _cross(px, w, bits, table, 1)
            elif t == 2:
                a, r, g, b = _channels(px)
                px = _joined(a, r + g, g, b + g)
            else:
                per, size = 1 << bits, 8 >> bits
                index = (px >> np.uint32(8) & np.uint32(255)).astype(np.int64).reshape(int(height[lane]), -1, 1) >> (np.arange(per) * size) & ((1 << size) - 1)
                index = index.reshape(int(height[lane]), -1)[:, :w].ravel()
                px = np.where(index < len(table), table[np.minimum(index, len(table) - 1)], np.uint32(0)).astype(np.uint32)
        out.append((int(width[lane]), int(height[lane]), px))
    return out


# --- columns ---


def payload_of(text: str | None) -> bytes:
    """The text's bytes and zeros up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 if raw else 64)


def stored(payload: bytes) -> list[bytes]:
    """The payload as lossless WebP files of four samples a pixel, one after the other."""
    px, per = np.frombuffer(payload, "<u4"), WIDTH * ROWS
    return [encode(px[lo : lo + per], WIDTH) for lo in range(0, len(px), per)]


def split(media: bytes) -> list[bytes]:
    """The files of a sequence."""
    out, at = [], 0
    while at < len(media):
        size = 8 + struct.unpack_from("<I", media, at + 4)[0]
        out.append(media[at : at + size])
        at += size
    return out


def feature(payload: bytes) -> str:
    """One bit for each 64th of the samples, 1 where its mean is over that of all, as 16 hex digits."""
    x = np.frombuffer(payload, np.uint8).reshape(64, -1).mean(1)
    return np.packbits(x > x.mean()).tobytes().hex()


def read_back(media: list[bytes]) -> list[bytes]:
    """The samples of each sequence of files. Images of like size are decoded together."""
    files = [(i, k, f) for i, m in enumerate(media) for k, f in enumerate(split(m))]
    parts: list[dict[int, bytes]] = [{} for _ in media]
    order = sorted(range(len(files)), key=lambda j: len(files[j][2]))
    for lo in range(0, len(order), LANES):
        some = [files[j] for j in order[lo : lo + LANES]]
        for (i, k, _), (_, _, px) in zip(some, decode([f for _, _, f in some]), strict=True):
            parts[i][k] = px.astype("<u4").tobytes()
    return [b"".join(p[k] for k in sorted(p)) for p in parts]


def columns(docs: DataFrame, rows: int = 4000, most_bytes: int = 24_000_000) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, media (the
    files themselves) for each document. Values depend on the text alone; null and empty texts are 64 zeros. A task
    holds at most `rows` texts, or `most_bytes` of them and one more, at a time."""
    schema = T.StructType([*docs.select("doc_id").schema.fields, *(T.StructField(n, t) for n, t in (("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()), ("media", T.BinaryType())))])
    names = schema.names

    def flush(ids, texts, kind):
        media = [b"".join(stored(payload_of(t))) for t in texts]
        back = read_back(media)
        cols = [[len((t or "").encode()) for t in texts], [len(p) for p in back], [hashlib.sha256(p).hexdigest() for p in back], [zlib.crc32(p[-64:]) for p in back], [len(m) for m in media], [hashlib.sha256(m).hexdigest() for m in media], [feature(p) for p in back], media]
        kinds = [kind, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([ids, *cols], kinds, strict=True)], names=names)

    def run(batches):
        ids, texts, size, kind = [], [], 0, None
        for b in batches:
            kind = b.schema.field(0).type
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t or "")
                if len(ids) >= rows or size >= most_bytes:
                    yield flush(ids, texts, kind)
                    ids, texts, size = [], [], 0
        if ids:
            yield flush(ids, texts, kind)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
