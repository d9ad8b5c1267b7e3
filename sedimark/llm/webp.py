"""Lossless WebP (VP8L) over many images at once.

decode() reads prefix codes, back-references, colour caches and meta prefix codes, and inverts the predictor,
cross-colour, subtract-green and palette transforms. It runs all images in lock step: one step decodes one pixel of
every image with array operations, so the cost of a step is shared by all.

encode() writes RGB images. Each gets prefix codes of its own, back-references found by equal stretches of four pixels,
and, where an estimate of its bits says that it pays, a colour cache, a predictor, cross-colour factors or a palette.
No choice for one image depends on others written with it.

ARGB pixels are unsigned 32-bit numbers, alpha highest.
"""

from __future__ import annotations

import struct

import numpy as np

#: Fixed values of the format: the order in which lengths of the code-length code are stored, and the hash multiplier.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
CACHE_HASH = 0x1E35A7BD
#: Near distances: points above and left (y rows up, x columns left) by Euclidean distance, then by |x|, right side last.
NEAR = np.array(sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)))
GREEN, LITERALS, LENGTHS, DISTANCES = 280, 256, 24, 40
_U8, _U32, _I64 = np.uint8, np.uint32, np.int64


class WebPError(ValueError):
    """Not a lossless WebP image, or a damaged one."""


def _reversed_bits(n: int) -> np.ndarray:
    x = np.arange(1 << n)
    out = np.zeros_like(x)
    for k in range(n):
        out |= ((x >> k) & 1) << (n - 1 - k)
    return out


_REVERSED = [_reversed_bits(n) for n in range(16)]


class Codes:
    """Lookup tables of many prefix codes: entry = symbol << 4 | length, by the next bits of the stream."""

    def __init__(self, lengths: np.ndarray):
        """lengths: codes x symbols. A code of one symbol takes no bits."""
        n = len(lengths)
        used = lengths > 0
        count = used.sum(1)
        most = np.where(count > 1, lengths.max(1, initial=0), 0).astype(_I64)
        kraft = np.where(used, 1 << (15 - np.minimum(lengths, 15).astype(_I64)), 0).sum(1)
        if ((count > 1) & (kraft != 1 << 15)).any() or (count == 0).any():
            raise WebPError("a prefix code is not complete")
        self.mask = ((1 << most) - 1).astype(_U32)
        self.base = np.r_[0, np.cumsum(1 << most)][:-1].astype(_I64)
        row, symbol = np.nonzero(used)
        length = np.where(count[row] > 1, lengths[row, symbol], 0).astype(_I64)
        order = np.lexsort((symbol, length, row))
        row, symbol, length = row[order], symbol[order], length[order]
        table = np.repeat((symbol << 4 | length).astype(_U32), 1 << (most[row] - length))
        self.table = np.empty_like(table)
        for m in np.unique(most):
            base = self.base[most == m][:, None]
            self.table[base + _REVERSED[m]] = table[base + np.arange(1 << m)]
        self.trivial = most == 0
        self.count = n


class _Bits:
    """Bit positions of many streams in one buffer."""

    def __init__(self, data: bytes, at: np.ndarray):
        b = np.frombuffer(data + b"\0" * 8, _U8).astype(_U32)
        self.words = b[:-3] | b[1:-2] << _U32(8) | b[2:-1] << _U32(16) | b[3:] << _U32(24)
        self.at = at.astype(_I64) * 8
        self.end = len(self.words) - 1

    def peek(self, lanes: np.ndarray) -> np.ndarray:
        """At least 25 bits from each lane's position."""
        at = self.at[lanes]
        return self.words[np.minimum(at >> 3, self.end)] >> (at & 7).astype(_U32)

    def read(self, lanes: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        out = self.peek(lanes) & ((np.int64(1) << np.asarray(n, _I64)) - 1).astype(_U32)
        self.at[lanes] += n
        return out.astype(_I64)

    def symbol(self, lanes: np.ndarray, codes: Codes, which: np.ndarray) -> np.ndarray:
        entry = codes.table[codes.base[which] + (self.peek(lanes) & codes.mask[which])]
        self.at[lanes] += entry & _U32(15)
        return (entry >> _U32(4)).astype(_I64)


def _read_lengths(bits: _Bits, lanes: np.ndarray, size: np.ndarray, widest: int) -> np.ndarray:
    """One prefix code's lengths for each lane; size: its alphabet."""
    out = np.zeros((len(lanes), widest), _U8)
    simple = bits.read(lanes, 1) == 1
    k = np.flatnonzero(simple)
    if len(k):
        own = lanes[k]
        two = bits.read(own, 1) == 1
        eight = bits.read(own, 1) == 1
        first = bits.read(own, np.where(eight, 8, 1))
        if (first >= size[k]).any():
            raise WebPError("a symbol beyond its alphabet")
        out[k, first] = 1
        second = bits.read(own[two], 8)
        if (second >= size[k][two]).any():
            raise WebPError("a symbol beyond its alphabet")
        out[k[two], second] = 1
    k = np.flatnonzero(~simple)
    if not len(k):
        return out
    own = lanes[k]
    n = 4 + bits.read(own, 4)
    inner = np.zeros((len(k), 19), _U8)
    for j, s in enumerate(LENGTH_ORDER):
        some = n > j
        inner[some, s] = bits.read(own[some], 3)
    codes = Codes(inner)
    left = size[k].copy()
    some = bits.read(own, 1) == 1
    width = 2 + 2 * bits.read(own[some], 3)
    left[some] = 2 + bits.read(own[some], width)
    at, last = np.zeros(len(k), _I64), np.full(len(k), 8)
    live = np.arange(len(k))
    while len(live := live[(at[live] < size[k][live]) & (left[live] > 0)]):
        left[live] -= 1
        s = bits.symbol(own[live], codes, live)
        plain = s < 16
        p = live[plain]
        out[k[p], at[p]] = s[plain]
        last[p] = np.where(s[plain] > 0, s[plain], last[p])
        at[p] += 1
        r = live[~plain]
        if len(r):
            s = s[~plain]
            times = np.where(s == 18, 11, 3) + bits.read(own[r], np.where(s == 16, 2, np.where(s == 17, 3, 7)))
            if (at[r] + times > size[k][r]).any():
                raise WebPError("code lengths beyond the alphabet")
            for lane, t in zip(r[s == 16].tolist(), times[s == 16].tolist()):
                out[k[lane], at[lane] : at[lane] + t] = last[lane]
            at[r] += times
    return out


def _extra(bits: _Bits, lanes: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """The value of a length or distance prefix, with its extra bits."""
    n = np.where(prefix < 4, 0, (prefix - 2) >> 1)
    base = np.where(prefix < 4, prefix, (2 + (prefix & 1)) << n)
    low = bits.read(lanes, np.minimum(n, 14))
    more = np.maximum(n - 14, 0)  # a peek is sure of 25 bits only
    return base + 1 + low + (bits.read(lanes, more) << 14)


def _image(bits: _Bits, lanes: np.ndarray, width: np.ndarray, height: np.ndarray, main: bool) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded images of all lanes: their ARGB pixels one after another, and where each begins."""
    cache = np.where(bits.read(lanes, 1) == 1, 1, 0)
    k = np.flatnonzero(cache)
    cache[k] = bits.read(lanes[k], 4)
    if ((cache[k] < 1) | (cache[k] > 11)).any():
        raise WebPError("a colour cache of no valid size")
    n = len(lanes)
    groups, tile, across = np.ones(n, _I64), np.zeros(n, _I64), np.zeros(n, _I64)
    meta, meta_at = np.zeros(0, _I64), np.zeros(n, _I64)
    if main and len(k := np.flatnonzero(bits.read(lanes, 1))):
        tile[k] = 2 + bits.read(lanes[k], 3)
        across[k] = -(-width[k] >> tile[k])
        found, start = _image(bits, lanes[k], across[k], -(-height[k] >> tile[k]), False)
        meta = ((found >> _U32(8)) & _U32(0xFFFF)).astype(_I64)
        meta_at[k] = start[:-1]
        groups[k] = 1 + np.maximum.reduceat(meta, start[:-1])
    green = GREEN + np.where(cache > 0, 1 << cache, 0)
    first = np.r_[0, np.cumsum(groups)]
    tables = [np.zeros((first[-1], int(green.max()) if c == 0 else DISTANCES if c == 4 else 256), _U8) for c in range(5)]
    for g in range(int(groups.max(initial=0))):
        some = np.flatnonzero(groups > g)
        for c in range(5):
            size = green[some] if c == 0 else np.full(len(some), tables[c].shape[1])
            tables[c][first[some] + g] = _read_lengths(bits, lanes[some], size, tables[c].shape[1])
    codes = [Codes(t) for t in tables]

    total = width * height
    start = np.r_[0, np.cumsum(total)].astype(_I64)
    out = np.zeros(start[-1], _U32)
    any_cache, with_cache, shift = cache.any(), cache > 0, (32 - cache).astype(_U32)
    slot = np.r_[0, np.cumsum(np.where(cache > 0, 1 << cache, 0))]
    colours = np.zeros(slot[-1], _U32)
    left, back = np.zeros(n, _I64), np.zeros(n, _I64)  # of a running copy
    place = start[:-1].copy()
    flat_alpha = codes[3].trivial.all()
    alpha_of = codes[3].table[codes[3].base] >> _U32(4)
    live = np.flatnonzero(total > 0)
    step = 0
    while len(live):
        own = live
        copying = left[own] > 0
        some_copy = copying.any()
        if some_copy:
            own = live[~copying]
        if len(own):
            which = first[own]
            if len(meta):
                at = place[own] - start[own]
                y, x = at // width[own], at % width[own]
                spot = meta_at[own] + (y >> tile[own]) * across[own] + (x >> tile[own])
                which = which + np.where(tile[own] > 0, meta[np.minimum(spot, len(meta) - 1)], 0)
            lane = lanes[own]
            at = bits.at[lane]
            words, end = bits.words, bits.end

            def take(code: Codes, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                word = words[np.minimum(at >> 3, end)] >> (at & 7).astype(_U32)
                entry = code.table[code.base[which] + (word & code.mask[which])]
                return entry >> _U32(4), at + (entry & _U32(15))

            g, at = take(codes[0], at, which)
            odd = g >= LITERALS
            if not odd.any():
                r, at = take(codes[1], at, which)
                b, at = take(codes[2], at, which)
                if flat_alpha:
                    a = alpha_of[which]
                else:
                    a, at = take(codes[3], at, which)
                bits.at[lane] = at
                out[place[own]] = a << _U32(24) | r << _U32(16) | g << _U32(8) | b
            else:
                bits.at[lane] = at
                p = np.flatnonzero(~odd)
                if len(p):
                    r, at = take(codes[1], at[p], which[p])
                    b, at = take(codes[2], at, which[p])
                    a, at = take(codes[3], at, which[p])
                    bits.at[lane[p]] = at
                    out[place[own[p]]] = a << _U32(24) | r << _U32(16) | g[p] << _U32(8) | b
                p = np.flatnonzero(odd & (g < GREEN))
                if len(p):
                    length = _extra(bits, lane[p], g[p].astype(_I64) - LITERALS)
                    far = _extra(bits, lane[p], bits.symbol(lane[p], codes[4], which[p]))
                    near = NEAR[np.minimum(far, 120) - 1]
                    far = np.where(far > 120, far - 120, np.maximum(1, near[:, 0] + near[:, 1] * width[own[p]]))
                    at = place[own[p]]
                    if (far > at - start[own[p]]).any() or (length > start[own[p] + 1] - at).any():
                        raise WebPError("a back-reference outside the image")
                    left[own[p]], back[own[p]] = length, far
                p = np.flatnonzero(g >= GREEN)
                if len(p):
                    out[place[own[p]]] = colours[slot[own[p]] + g[p].astype(_I64) - GREEN]
                some_copy = some_copy or (left[own] > 0).any()
        if some_copy:
            c = live[left[live] > 0]
            out[place[c]] = out[place[c] - back[c]]
            left[c] -= 1
        if any_cache:
            c = live[with_cache[live]]
            pixel = out[place[c]]
            colours[slot[c] + ((pixel * _U32(CACHE_HASH)) >> shift[c])] = pixel
        place[live] += 1
        step += 1
        if not step % 16 or len(live) < 64 or not main:
            live = live[place[live] < start[live + 1]]
        elif (ended := place[live] >= start[live + 1]).any():
            live = live[~ended]
    return out, start


def _bytes_of(pixels: np.ndarray) -> np.ndarray:
    """ARGB numbers as rows of four whole numbers: alpha, red, green, blue."""
    return np.stack([(pixels >> _U32(s)) & _U32(255) for s in (24, 16, 8, 0)], -1).astype(np.int32)


def _number_of(parts: np.ndarray) -> np.ndarray:
    p = (parts & 255).astype(_U32)
    return p[..., 0] << _U32(24) | p[..., 1] << _U32(16) | p[..., 2] << _U32(8) | p[..., 3]


def _predict(mode: np.ndarray, left: np.ndarray, top: np.ndarray, right: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """The predicted pixels (rows of four channels), each by its own mode, from their left, top, top-right and top-left neighbours."""
    half = lambda a, b: (a + b) >> 1
    out = np.tile(np.array([255, 0, 0, 0], np.int32), (len(mode), 1))
    for m in np.unique(mode):
        k = np.flatnonzero(mode == m)
        l, t, r, c = left[k], top[k], right[k], corner[k]  # noqa: E741
        if m == 11:
            guess = l + t - c
            out[k] = np.where((np.abs(guess - l).sum(1) < np.abs(guess - t).sum(1))[:, None], l, t)
        elif m == 12:
            out[k] = np.clip(l + t - c, 0, 255)
        elif m == 13:
            mean = half(l, t)
            out[k] = np.clip(mean + np.trunc((mean - c) / 2).astype(np.int32), 0, 255)  # halves round towards zero
        elif 1 <= m <= 10:
            out[k] = (
                l, t, r, c, half(half(l, r), t), half(l, c), half(l, t), half(c, t), half(t, r), half(half(l, c), half(t, r)),
            )[m - 1]
    return out


def invert_predictor(pixels: np.ndarray, modes: np.ndarray, tile: int) -> np.ndarray:
    """Adds to each residual (images x h x w) the prediction of its tile's mode (green channel of ``modes``).

    Pixels with equal x + 2 y depend only on smaller ones, so those of all images are decoded together.
    """
    n, h, w = pixels.shape
    parts, mode = _bytes_of(pixels), ((modes >> _U32(8)) & _U32(15)).astype(np.int32)
    parts[:, 0, 0] = (parts[:, 0, 0] + (255, 0, 0, 0)) & 255
    parts[:, 0] = np.cumsum(parts[:, 0], 1) & 255  # the first row adds its left neighbour
    for front in range(2, w + 2 * (h - 1)):
        y = np.arange(max(1, (front - w + 2) // 2), min(h - 1, front // 2) + 1)
        x = front - 2 * y
        if not len(y):
            continue
        beyond = np.where((x + 1 < w)[:, None], parts[:, y - 1, np.minimum(x + 1, w - 1)], parts[:, y, 0])
        around = (parts[:, y, x - 1], parts[:, y - 1, x], beyond, parts[:, y - 1, x - 1])
        guess = _predict(mode[:, y >> tile, x >> tile].ravel(), *(a.reshape(-1, 4) for a in around)).reshape(n, len(y), 4)
        guess[:, x == 0] = parts[:, y - 1, 0][:, x == 0]
        parts[:, y, x] = (parts[:, y, x] + guess) & 255
    return _number_of(parts)


def invert_cross_colour(pixels: np.ndarray, factors: np.ndarray, tile: int) -> np.ndarray:
    """Adds what green gave to red, and green and red to blue, by the factors of each tile, for images x h x w."""
    signed = lambda x: x.astype(np.int8).astype(np.int32)
    _, h, w = pixels.shape
    parts = _bytes_of(pixels)
    f = _bytes_of(factors)[:, np.arange(h)[:, None] >> tile, np.arange(w)[None] >> tile]
    red_blue, green_blue, green_red = signed(f[..., 1]), signed(f[..., 2]), signed(f[..., 3])
    green = signed(parts[..., 2])
    parts[..., 1] = (parts[..., 1] + ((green_red * green) >> 5)) & 255
    parts[..., 3] = (parts[..., 3] + ((green_blue * green) >> 5) + ((red_blue * signed(parts[..., 1])) >> 5)) & 255
    return _number_of(parts)


def invert_subtract_green(pixels: np.ndarray) -> np.ndarray:
    parts = _bytes_of(pixels)
    parts[..., 1] += parts[..., 2]
    parts[..., 3] += parts[..., 2]
    return _number_of(parts)


def invert_palette(pixels: np.ndarray, palette: np.ndarray, width: int, pack: int) -> np.ndarray:
    """Looks up each index in the palette; 2**pack indices lie in one green byte. An index beyond the palette is 0."""
    green = (pixels >> _U32(8)) & _U32(255)
    each = 8 >> pack
    x = np.arange(width)
    index = (green[:, x >> pack] >> ((x & ((1 << pack) - 1)) * each).astype(_U32)) & _U32((1 << each) - 1)
    return np.concatenate([palette, np.zeros(256, _U32)])[index]


def decode(files: list[bytes]) -> list[np.ndarray]:
    """The ARGB pixels (height x width) of lossless WebP files."""
    if not files:
        return []
    starts, data = [], []
    at = 0
    for f in files:
        if len(f) < 25 or f[:4] != b"RIFF" or f[8:16] != b"WEBPVP8L" or f[20] != 0x2F:
            raise WebPError("no lossless WebP file")
        starts.append(at + 21)
        data.append(f)
        at += len(f)
    bits = _Bits(b"".join(data), np.array(starts))
    lanes = np.arange(len(files))
    width, height = 1 + bits.read(lanes, 14), 1 + bits.read(lanes, 14)
    bits.read(lanes, 1)  # whether alpha is used is only a hint
    if bits.read(lanes, 3).any():
        raise WebPError("an unknown version")
    coded, undo = width.copy(), [[] for _ in files]
    live = lanes
    while len(live := live[bits.read(live, 1) == 1]):
        kind = bits.read(live, 2)
        own = live[kind <= 1]
        if len(own):
            tile = 2 + bits.read(own, 3)
            w, h = -(-coded[own] >> tile), -(-height[own] >> tile)
            found, s = _image(bits, own, w, h, False)
            for k, lane in enumerate(own.tolist()):
                step = invert_predictor if kind[live == lane][0] == 0 else invert_cross_colour
                undo[lane].append((step, (found[s[k] : s[k + 1]].reshape(h[k], w[k]), int(tile[k]))))
        for lane in live[kind == 2].tolist():
            undo[lane].append((invert_subtract_green, ()))
        own = live[kind == 3]
        if len(own):
            size = 1 + bits.read(own, 8)
            found, s = _image(bits, own, size, np.ones_like(size), False)
            pack = np.select([size <= 2, size <= 4, size <= 16], [3, 2, 1], 0)
            for k, lane in enumerate(own.tolist()):
                palette = _number_of(np.cumsum(_bytes_of(found[s[k] : s[k + 1]]), 0))
                undo[lane].append((invert_palette, (palette, int(coded[lane]), int(pack[k]))))
            coded[own] = -(-coded[own] >> pack)
    pixels, s = _image(bits, lanes, coded, height, True)
    if (bits.at > 8 * np.cumsum([len(f) for f in files])).any():
        raise WebPError("the data ends early")
    out = [pixels[s[k] : s[k + 1]].reshape(height[k], coded[k]) for k in range(len(files))]
    while any(undo):
        # the last transform of each image; equal steps over images of one shape are inverted together
        alike: dict[tuple, list[int]] = {}
        for k, steps in enumerate(undo):
            if steps:
                step, args = steps[-1]
                together = step in (invert_predictor, invert_cross_colour)
                alike.setdefault((step, out[k].shape, args[1]) if together else (step, k), []).append(k)
        for (step, *_), ks in alike.items():
            last = [undo[k].pop()[1] for k in ks]
            if step in (invert_predictor, invert_cross_colour):
                done = step(np.stack([out[k] for k in ks]), np.stack([x[0] for x in last]), last[0][1])
            else:
                done = [step(out[ks[0]], *last[0])]
            for k, image in zip(ks, done):
                out[k] = image
    return out


# --- writing -------------------------------------------------------------------------------------------------------

_MOST = 11  # longest code that encode() gives
#: Lengths of the code-length code that encode() uses for all images: 3 bits for 10 and 11, 4 for the others in use.
_INNER = np.array([4, 4, 4, 4, 4, 4, 4, 4, 4, 4, 3, 3, 0, 0, 0, 0, 0, 4, 4])
#: Pixels of a back-reference at least and at most; bits of the colour cache; bits of a tile's side.
_COPY, _LONGEST, _CACHE, _TILE = 4, 4096, 8, 3
#: Predictor modes that encode() tries for each tile: black, left, top, top-right, top-left.
_MODES = (0, 1, 2, 3, 4)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths (at most 11) of complete prefix codes for rows of symbol counts; one used symbol has length 1.

    Starts from the rounded-up information content and spends what is left of Kraft's sum on the commonest symbols.
    """
    n, wide = counts.shape
    used = counts > 0
    total = counts.sum(1, keepdims=True)
    smooth = np.where(used, np.maximum(counts, total / 1024), 0.0)
    share = smooth / np.maximum(smooth.sum(1, keepdims=True), 1e-9)
    length = np.where(used, np.ceil(-np.log2(np.where(used, share, 1)) - 1e-12), 0).astype(_I64)
    length = np.where(used, np.maximum(length, 1), 0)
    many = used.sum(1) > 1
    order = np.argsort(-counts, axis=1, kind="stable")[:, : max(1, int(used.sum(1).max(initial=1)))]
    ranked = np.take_along_axis(length, order, 1)
    room = (1 << _MOST) - np.where(ranked > 0, 1 << (_MOST - ranked), 0).sum(1)
    room[~many] = 0
    while len(open_ := np.flatnonzero(room > 0)):
        now = ranked[open_]
        rest = room[open_]
        for bit in range(2, _MOST + 1):  # a symbol of length ``bit`` costs as much again to be one shorter
            able = now == bit
            chosen = able & (np.cumsum(able, 1) <= (rest >> (_MOST - bit))[:, None])
            now = now - chosen
            rest = rest - (chosen.sum(1) << (_MOST - bit))
        ranked[open_], room[open_] = now, rest
    np.put_along_axis(length, order, ranked, 1)
    return length


def code_bits(lengths: np.ndarray) -> np.ndarray:
    """The codes of rows of lengths, first bit lowest; 0 for the only symbol of a row."""
    row, symbol = np.nonzero(lengths)
    if not len(row):
        return np.zeros(lengths.shape, _I64)
    length = lengths[row, symbol].astype(_I64)
    order = np.lexsort((symbol, length, row))
    row, symbol, length = row[order], symbol[order], length[order]
    size = np.int64(1) << (15 - length)
    upto = np.cumsum(size) - size
    first = np.r_[True, row[1:] != row[:-1]]
    upto = upto - np.repeat(upto[first], np.diff(np.r_[np.flatnonzero(first), len(row)]))
    out = np.zeros(lengths.shape, _I64)
    turned = _REVERSED[15][upto]  # the code is in the highest bits: turned round, in the lowest
    out[row, symbol] = turned
    return out


class _Writer:
    """Puts values into a buffer of 64-bit words at given bit positions (rising, not overlapping)."""

    def __init__(self, words: int):
        self.words = np.zeros(words + 1, np.uint64)

    def put(self, at: np.ndarray, value: np.ndarray, size: np.ndarray) -> None:
        keep = size > 0
        if not keep.all():
            at, value, size = at[keep], value[keep], size[keep]
        if not len(at):
            return
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = value.astype(np.uint64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        self.words[word[first]] |= np.bitwise_or.reduceat(value << shift, first)
        over = np.flatnonzero((at & 63) + size > 64)
        self.words[word[over] + 1] |= value[over] >> (np.uint64(64) - shift[over])


def _length_prefix(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix, extra bits and their value for lengths from 1 on."""
    v = n - 1
    high = np.maximum(np.frexp(np.maximum(v, 1).astype(float))[1] - 1, 1)
    extra = np.where(v < 4, 0, high - 1)
    return np.where(v < 4, v, 2 * high + ((v >> (high - 1)) & 1)), extra, v & ((1 << extra) - 1)


def _entropy(values: np.ndarray, image: np.ndarray, n: int, wide: int) -> np.ndarray:
    """The information content in bits of each image's values."""
    counts = np.bincount(image * wide + values, minlength=n * wide).reshape(n, wide).astype(np.float64)
    total = counts.sum(1)
    return total * np.log2(np.maximum(total, 1)) - (counts * np.log2(np.maximum(counts, 1))).sum(1)


def _before(key: np.ndarray, bits: int) -> np.ndarray:
    """The last earlier position of an equal key (below 2**bits), or -1."""
    n, out = len(key), np.full(len(key), -1, _I64)
    if n >= 1 << (64 - bits):
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
    else:  # sorting key and position as one number is faster than a stable sort of keys
        both = np.sort(key.astype(np.uint64) << np.uint64(64 - bits) | np.arange(n, dtype=np.uint64))
        order = (both & np.uint64((1 << (64 - bits)) - 1)).astype(_I64)
        same = (both[1:] ^ both[:-1]) < 1 << (64 - bits)
    out[order[1:][same]] = order[:-1][same]
    return out


def _copies(pixels: np.ndarray, image: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first pixel, length, distance) of back-references, not overlapping. stop: the end of each pixel's image.

    Stretches of ``_COPY`` pixels that occurred before, at one distance for neighbouring pixels, are one copy; where two
    overlap the later one is cut short.
    """
    n = len(pixels)
    none = np.zeros(0, _I64)
    if n < _COPY:
        return none, none, none
    m = n - _COPY + 1
    with np.errstate(over="ignore"):
        key = image[:m].astype(np.uint64)
        for j in range(_COPY):
            key = key * np.uint64(0x9E3779B97F4A7C15) + pixels[j : j + m]
    past = _before((key ^ key >> np.uint64(29)) >> np.uint64(24), 40)
    whole = (past >= 0) & (np.arange(m) + _COPY <= stop[:m])
    for j in range(_COPY):
        whole &= pixels[j : j + m] == pixels[np.maximum(past, 0) + j]
    at = np.flatnonzero(whole & (image[np.maximum(past, 0)] == image[:m]))
    if not len(at):
        return none, none, none
    far = at - past[at]
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (far[1:] != far[:-1])]
    first, last = at[new], at[np.r_[new[1:], True]] + _COPY
    far = far[new]
    first = np.maximum(first, np.r_[0, last[:-1]])  # ends rise, so only the one before can overlap
    keep = last - first >= _COPY
    first, last, far = first[keep], last[keep], far[keep]
    return first, np.minimum(last - first, _LONGEST), far


def _distance_codes(width: int) -> np.ndarray:
    """The code of each distance up to 8 rows: the first near one that gives it, else the distance and 120."""
    out = np.arange(9 * width + 16) + 120
    given = np.maximum(1, NEAR[:, 0] + NEAR[:, 1] * width)
    for code in range(len(given), 0, -1):
        out[given[code - 1]] = code
    return out


def _streams(pixels: np.ndarray, total: np.ndarray, width: int, main: bool, cached: bool = False, lead: int = 0) -> list[tuple[bytes, int]]:
    """Entropy-coded images, one after another in ``pixels``: the bytes of each and their number of bits, after ``lead`` zero bits."""
    n = len(total)
    start = np.r_[0, np.cumsum(total)]
    image = np.repeat(np.arange(n), total)
    parts = pixels.astype("<u4").view(_U8).reshape(-1, 4)  # blue, green, red, alpha
    none = np.zeros(0, _I64)
    begin, run, far = _copies(pixels, image, np.repeat(start[1:], total)) if main else (none, none, none)
    drop = np.zeros(len(pixels) + 1, _I64)
    np.add.at(drop, begin, 1)
    np.add.at(drop, begin + run, -1)
    literal = np.cumsum(drop[:-1]) == 0
    hit = np.zeros(0, _I64)
    if cached:
        slot = ((pixels.astype(np.uint64) * np.uint64(CACHE_HASH)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - _CACHE)
        past = _before(image << _CACHE | slot.astype(_I64), 40)
        known = literal & (past >= 0)
        known[known] = pixels[past[known]] == pixels[known]
        hit, literal = np.flatnonzero(known), literal & ~known
        slot = slot[hit].astype(_I64)
    prefix, extra, rest = _length_prefix(run)
    near = _distance_codes(width)
    d_prefix, d_extra, d_rest = _length_prefix(np.where(far < len(near), near[np.minimum(far, len(near) - 1)], far + 120))

    at = np.flatnonzero(literal)
    own = image[at]
    wide = GREEN + (1 << _CACHE if cached else 0)
    spots_of = [own * (wide if c == 1 else 256) + parts[at, c] for c in (1, 2, 0, 3)]  # of each literal, in each table
    counts = [np.bincount(spots_of[0], minlength=n * wide).reshape(n, wide)]
    np.add.at(counts[0], (image[begin], LITERALS + prefix), 1)
    if cached:
        np.add.at(counts[0], (image[hit], GREEN + slot), 1)
    counts += [np.bincount(x, minlength=n * 256).reshape(n, 256) for x in spots_of[1:]]
    counts.append(np.bincount(image[begin] * DISTANCES + d_prefix, minlength=n * DISTANCES).reshape(n, DISTANCES))
    # codes of one symbol take no bits; the others get lengths, codes, and headers: (order, value, bits) pieces of each image
    inner = code_bits(_INNER[None])[0]
    lengths, codes, heads = [], [], []
    for c in counts:
        one = (c > 0).sum(1) <= 1
        many = np.flatnonzero(~one)
        x, bits = np.zeros(c.shape, _I64), np.zeros(c.shape, _I64)
        lengths.append(x)
        codes.append(bits)
        if not len(many):
            heads.append((one, c.argmax(1), none, none, none))
            continue
        own_lengths = code_lengths(c[many])
        x[many], bits[many] = own_lengths, code_bits(own_lengths)
        wide = c.shape[1]
        flat = own_lengths.ravel()
        zero = flat == 0
        edge = np.zeros(len(flat) + 1, bool)
        edge[::wide] = True
        go = np.flatnonzero(zero & (edge[:-1] | ~np.r_[False, zero[:-1]]))
        stop = np.flatnonzero(zero & (edge[1:] | ~np.r_[zero[1:], False])) + 1
        token = np.where(zero, -1, flat)
        more, more_bits = np.zeros(len(flat), _I64), np.zeros(len(flat), _I64)
        while len(go):
            left = stop - go
            part = np.where(left >= 11, np.minimum(left, 138), np.where(left >= 3, left, 1))
            token[go] = np.where(left >= 11, 18, np.where(left >= 3, 17, 0))
            more[go] = np.where(left >= 11, part - 11, np.where(left >= 3, part - 3, 0))
            more_bits[go] = np.where(left >= 11, 7, np.where(left >= 3, 3, 0))
            go, stop = (go + part)[part < left], stop[part < left]
        keep = np.flatnonzero(token >= 0)
        token, more, more_bits = token[keep], more[keep], more_bits[keep]
        heads.append((one, c.argmax(1), many[keep // wide], inner[token] | more << _INNER[token], _INNER[token] + more_bits))

    head_value, head_size = 0, 0
    for v, b in [(0, 1), (15, 4), *((int(_INNER[s]), 3) for s in LENGTH_ORDER), (0, 1)]:
        head_value |= v << head_size
        head_size += b
    # whether there is a cache, of how many bits, and, in a main image, no meta codes
    size = np.full(n, lead + 1 + 4 * cached + main, _I64)
    spots = []
    for one, _, row, _, bits in heads:
        spots.append(size.copy())
        size += np.where(one, 11, head_size) + np.bincount(row, bits, n).astype(_I64)
    value, bits = np.zeros(len(pixels), _I64), np.zeros(len(pixels), _I64)
    v, z = np.zeros(len(at), _I64), np.zeros(len(at), _I64)
    for k, spot in enumerate(spots_of):
        if heads[k][0].all():  # one symbol everywhere
            continue
        both = (codes[k] << 4 | lengths[k]).ravel()[spot]
        v |= (both >> 4) << z
        z += both & 15
    value[at], bits[at] = v, z
    symbol = LITERALS + prefix
    length, d_length = lengths[0][image[begin], symbol], lengths[4][image[begin], d_prefix]
    value[begin] = codes[0][image[begin], symbol] | rest << length | codes[4][image[begin], d_prefix] * (d_length > 0) << (length + extra) | d_rest << (length + extra + d_length)
    bits[begin] = length + extra + d_length + d_extra
    if cached:
        value[hit], bits[hit] = codes[0][image[hit], GREEN + slot], lengths[0][image[hit], GREEN + slot]
    upto = np.cumsum(bits) - bits
    body = upto - np.repeat(upto[np.minimum(start[:-1], max(0, len(upto) - 1))], total)
    data_at = size.copy()
    size += np.bincount(image, bits, n).astype(_I64)
    base = np.r_[0, np.cumsum(-(-size >> 6))][:-1] * 64
    out = _Writer(int((-(-size >> 6)).sum()) + 1)
    if cached:
        out.put(base + lead, np.full(n, 1 | _CACHE << 1), np.full(n, 5))
    for (one, symbol, row, token, token_bits), spot in zip(heads, spots):
        k = np.flatnonzero(one)
        out.put(base[k] + spot[k], 0b101 | symbol[k] << 3, np.full(len(k), 11))
        k = np.flatnonzero(~one)
        out.put(base[k] + spot[k], np.full(len(k), head_value & (2**32 - 1)), np.full(len(k), 32))
        out.put(base[k] + spot[k] + 32, np.full(len(k), head_value >> 32), np.full(len(k), head_size - 32))
        each = np.cumsum(token_bits) - token_bits
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else none
        each = each - np.repeat(each[firsts], np.diff(np.r_[firsts, len(row)]))
        out.put(base[row] + spot[row] + head_size + each, token, token_bits)
    out.put(base[image] + data_at[image] + body, value, bits)
    stream = out.words.astype("<u8").tobytes()
    return [(stream[b // 8 : b // 8 + (z + 7) // 8], z) for b, z in zip(base.tolist(), size.tolist())]


def _cache_pays(pixels: np.ndarray, image: np.ndarray, n: int) -> np.ndarray:
    """Images that a colour cache is estimated to make smaller."""
    parts = pixels.astype("<u4").view(_U8).reshape(-1, 4)
    slot = (((pixels.astype(np.uint64) * np.uint64(CACHE_HASH)) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - _CACHE)).astype(_I64)
    past = _before(image << _CACHE | slot, 40)
    known = past >= 0
    known[known] = pixels[past[known]] == pixels[known]
    plain = sum(_entropy(parts[:, c], image, n, 256) for c in range(3))
    rest = ~known
    wide = 256 + (1 << _CACHE)
    mixed = _entropy(np.where(known, 256 + slot, parts[:, 1]), image, n, wide)
    mixed += sum(_entropy(parts[rest, c], image[rest], n, 256) for c in (0, 2))
    used = np.unique(image[known] << _CACHE | slot[known]) >> _CACHE
    return mixed + 5 * np.bincount(used, minlength=n) + 40 < plain


def _predicted(pixels: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(residuals, modes, tiles of each image, images): for each tile the mode that leaves fewest channels that are not
    zero; residuals and modes only of the images that keep at most half of them."""
    n, total = len(rows), rows * width
    image = np.repeat(np.arange(n), total)
    place = np.arange(len(pixels)) - np.repeat(np.r_[0, np.cumsum(total)][:-1], total)
    y, x = place // width, place % width
    across, down = -(-width >> _TILE), -(-rows >> _TILE)
    size = across * down
    tiles = np.r_[0, np.cumsum(size)]
    tile = tiles[image] + (y >> _TILE) * across + (x >> _TILE)
    inner = np.flatnonzero((x > 0) & (y > 0))
    sub = lambda a, b: (a.view(_U8) - b.view(_U8)).view(_U32)
    back = (0, 1, width, width - 1, width + 1)
    here, where = pixels[inner], tile[inner]
    best, modes = np.full(tiles[-1], 1 << 30), np.zeros(tiles[-1], _I64)
    for m in _MODES:
        left = here ^ (pixels[inner - back[m]] if m else _U32(0xFF000000))
        off = (((left & _U32(0x7F7F7F7F)) + _U32(0x7F7F7F7F)) | left) & _U32(0x80808080)  # a bit for each channel
        cost = np.bincount(where, np.bitwise_count(off), tiles[-1]).astype(_I64)
        modes, best = np.where(cost < best, m, modes), np.minimum(cost, best)
    kept = np.add.reduceat(np.where(best < 1 << 30, best, 0), tiles[:-1])
    ks = np.flatnonzero((2 * kept <= 3 * total) & (rows > 1))
    some = np.isin(image, ks)
    at = np.flatnonzero(some)
    steps = np.array(back)[modes[tile[at]]]
    steps = np.where(x[at] == 0, width, np.where(y[at] == 0, 1, steps))
    first = (place[at] == 0) | (steps == 0)
    guess = np.where(first, _U32(0xFF000000), pixels[at - np.where(first, 0, steps)])
    return sub(pixels[at], guess.astype(_U32)), _taken(modes, size, ks), size, ks


def _factors(pixels: np.ndarray, image: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(green to red, green to blue, red to blue) of each image: what fits the channels best, as signed 32nds; and where
    green tells at least half of what red or blue vary by."""
    signed = pixels.astype("<u4").view(np.int8).reshape(-1, 4)
    blue, green, red = (signed[:, c].astype(np.int32) for c in range(3))
    start = np.searchsorted(image, np.arange(n))
    mean = lambda v: np.add.reduceat(v, start, dtype=_I64).astype(np.float64)
    size = np.bincount(image, minlength=n).astype(np.float64)
    vary = lambda a, b: mean(a * b) - mean(a) * mean(b) / size
    slope = lambda shared, spread: np.clip(np.round(32 * shared / np.maximum(spread, 1e-9)), -127, 127).astype(_I64)
    spread, in_red, in_blue = vary(green, green), vary(green, red), vary(green, blue)
    red_own, blue_own = vary(red, red), vary(blue, blue)
    fits = (2 * in_red**2 >= spread * red_own) & (red_own > 0) | (2 * in_blue**2 >= spread * blue_own) & (blue_own > 0)
    green_red, green_blue = slope(in_red, spread), slope(in_blue, spread)
    left = vary(blue, red) - green_blue / 32 * in_red  # of blue less what green gives, with red
    return np.stack([green_red, green_blue, slope(left, red_own)], 1), fits


def _crossed(pixels: np.ndarray, image: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Red less what green gives, and blue less what green and red give: what invert_cross_colour() undoes."""
    parts = pixels.astype("<u4").view(_U8).reshape(-1, 4)
    signed = parts.view(np.int8).astype(np.int32)
    out, f = parts.copy(), factors[image].astype(np.int32)
    out[:, 2] = (signed[:, 2] - ((f[:, 0] * signed[:, 1]) >> 5)) & 255
    out[:, 0] = (signed[:, 0] - ((f[:, 1] * signed[:, 1]) >> 5) - ((f[:, 2] * signed[:, 2]) >> 5)) & 255
    return out.view("<u4").ravel().astype(_U32)


def _choose(pixels: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, tuple, np.ndarray, tuple]:
    """For each image whether it is best as it is (0), with a predictor (1), with cross-colour factors (2) or by palette (3)."""
    n, total = len(rows), rows * width
    image = np.repeat(np.arange(n), total)
    channels = lambda p, of, k: sum(_entropy(p.astype("<u4").view(_U8).reshape(-1, 4)[:, c], of, k, 256) for c in range(3))

    def among(ks: np.ndarray, own: np.ndarray, more: np.ndarray) -> np.ndarray:
        out = np.full(n, np.inf)
        if len(ks):
            out[ks] = channels(own, np.repeat(np.arange(len(ks)), total[ks]), len(ks)) + more
        return out

    plain = channels(pixels, image, n)
    guessed = _predicted(pixels, rows, width)
    tiles, ks = guessed[2:]
    predicted = among(ks, guessed[0], 3.0 * tiles[ks] + 80)
    factors, fits = _factors(pixels, image, n)
    ks = np.flatnonzero(fits)
    crossed = among(ks, _crossed(_taken(pixels, total, ks), np.repeat(np.arange(len(ks)), total[ks]), factors[ks]), np.full(len(ks), 100.0)) if len(ks) else np.full(n, np.inf)
    every = np.sort(image.astype(np.uint64) << np.uint64(32) | pixels)
    new = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    colours, times = every[new], np.diff(np.r_[new, len(every)])
    own = (colours >> np.uint64(32)).astype(_I64)
    count = np.bincount(own, minlength=n)
    palette = total * np.log2(np.maximum(total, 1)) - np.bincount(own, times * np.log2(times), n) + 24.0 * count + 60
    palette[count > 256] = np.inf
    costs = [plain, predicted, crossed, palette]
    return np.argmin(np.stack(costs), 0), guessed, factors, (colours, own, count)


def _taken(values: np.ndarray, size: np.ndarray, ks: np.ndarray) -> np.ndarray:
    """The values of images ``ks`` alone, of ``values`` that hold ``size`` for each."""
    pick = np.zeros(len(size), bool)
    pick[ks] = True
    return values[np.repeat(pick, size)]


def _joined(*pieces: tuple[int, int]) -> int:
    """Values of given bits, one after another, as one number; ends in its own highest bit."""
    value, at = 0, 0
    for v, n in pieces:
        value |= v << at
        at += n
    return value | 1 << at


def encode(samples: np.ndarray, rows: np.ndarray, width: int) -> list[bytes]:
    """Lossless WebP files of RGB images of one width that lie one after another.

    samples: pixels x 3 bytes. rows: each image's height.
    """
    n, total = len(rows), rows * width
    pixels = _U32(0xFF000000) | samples[:, 0].astype(_U32) << _U32(16) | samples[:, 1].astype(_U32) << _U32(8) | samples[:, 2]
    if not n:
        return []
    kind, (residuals, modes, tiles, guessed), factors, (colours, colour_of, count) = _choose(pixels, rows, width)
    argb = lambda r, g, b: (_U32(0xFF000000) | (r & 255).astype(_U32) << _U32(16) | (g & 255).astype(_U32) << _U32(8) | (b & 255).astype(_U32))
    # what is written before the image itself, for each image: transforms, each after a bit and its kind
    before: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    as_number = lambda stream: (int.from_bytes(stream[0], "little"), stream[1])

    jobs: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []  # images, pixels, sizes, width
    if len(ks := np.flatnonzero(kind == 0)):
        jobs.append((ks, _taken(pixels, total, ks), total[ks], width))
    if len(ks := np.flatnonzero(kind == 1)):
        among = np.flatnonzero(np.isin(guessed, ks))
        own, m = _taken(residuals, total[guessed], among), _taken(modes, tiles[guessed], among)
        zero = np.zeros(len(m), _I64)
        for k, stream in zip(ks.tolist(), _streams(argb(zero, m, zero), tiles[ks], 1, False)):
            before[k] += [(1 | 0 << 1 | (_TILE - 2) << 3, 6), as_number(stream)]
        jobs.append((ks, own, total[ks], width))
    if len(ks := np.flatnonzero(kind == 2)):
        f = np.repeat(factors[ks], tiles[ks], axis=0)
        for k, stream in zip(ks.tolist(), _streams(argb(f[:, 2], f[:, 1], f[:, 0]), tiles[ks], 1, False)):
            before[k] += [(1 | 1 << 1 | (_TILE - 2) << 3, 6), as_number(stream)]
        own = _taken(pixels, total, ks)
        jobs.append((ks, _crossed(own, np.repeat(np.arange(len(ks)), total[ks]), factors[ks]), total[ks], width))
    if len(ks := np.flatnonzero(kind == 3)):
        held = np.isin(colour_of, ks)
        table, size = colours[held].astype(_U32), count[ks]
        first = np.r_[0, np.cumsum(size)][:-1]
        steps = table.copy().view(_U8).reshape(-1, 4)
        steps[1:] -= table.view(_U8).reshape(-1, 4)[:-1]
        steps[first] = table[first].view(_U8).reshape(-1, 4)
        for k, c, stream in zip(ks.tolist(), size.tolist(), _streams(steps.view(_U32).ravel(), size, 1, False)):
            before[k] += [(1 | 3 << 1 | (c - 1) << 3, 11), as_number(stream)]
        upto = np.r_[0, np.cumsum(count)]
        pack = np.select([size <= 2, size <= 4, size <= 16], [3, 2, 1], 0)
        for p in np.unique(pack).tolist():
            some = ks[pack == p]
            image = np.repeat(some, total[some])
            own = np.searchsorted(colours, image.astype(np.uint64) << np.uint64(32) | _taken(pixels, total, some)) - upto[image]
            own = own.reshape(-1, width)
            narrow = -(-width >> p)
            wide = np.zeros((len(own), narrow << p), _I64)
            wide[:, :width] = own
            packed = (wide.reshape(len(own), narrow, 1 << p) << (np.arange(1 << p) * (8 >> p))).sum(2).ravel()
            zero = np.zeros(len(packed), _I64)
            jobs.append((some, argb(zero, packed, zero), rows[some] * narrow, narrow))

    main: list[tuple[bytes, int]] = [(b"", 0)] * n
    for ks, own, size, wide in jobs:
        cache = _cache_pays(own, np.repeat(np.arange(len(ks)), size), len(ks))
        lead = int(kind[ks[0]] == 0)  # a zero bit ends the list of transforms: the first bit where there are none
        for c in (False, True):
            some = np.flatnonzero(cache == c)
            if len(some):
                for k, stream in zip(ks[some].tolist(), _streams(_taken(own, size, some), size[some], wide, True, c, lead)):
                    main[k] = stream
    files = []
    for k in range(n):
        stream = main[k][0]
        if before[k]:
            value = _joined(*before[k], (0, 1), as_number(main[k]))
            stream = (value ^ 1 << (value.bit_length() - 1)).to_bytes((value.bit_length() + 6) // 8, "little")
        payload = b"\x2f" + struct.pack("<I", (width - 1) | int(rows[k] - 1) << 14) + stream
        padded = payload + b"\0" * (len(payload) & 1)
        files.append(b"RIFF" + struct.pack("<I", 12 + len(padded)) + b"WEBPVP8L" + struct.pack("<I", len(payload)) + padded)
    return files
