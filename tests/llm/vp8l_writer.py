"""A slow writer of lossless WebP files that uses every part of the format, for testing the reader."""

import heapq
import struct
from collections import Counter

ORDER = [17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]


class Bits:
    def __init__(self):
        self.out = []

    def put(self, value, n):
        self.out += [(value >> k) & 1 for k in range(n)]

    def code(self, code):
        self.out += code

    def bytes(self):
        bits = self.out + [0] * (-len(self.out) % 8)
        return bytes(sum(b << k for k, b in enumerate(bits[i : i + 8])) for i in range(0, len(bits), 8))


def huffman(counts, most):
    """Code lengths by Huffman's algorithm; flattens the counts until no code is longer than ``most``."""
    counts = {s: c for s, c in counts.items() if c}
    if len(counts) == 1:
        return {next(iter(counts)): 1}
    while True:
        heap = [(c, s, (s,)) for s, c in counts.items()]
        heapq.heapify(heap)
        depth = Counter()
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
        if max(depth.values()) <= most:
            return dict(depth)
        counts = {s: (c + 1) // 2 + 1 for s, c in counts.items()}


def canonical(lengths):
    code, last, out = 0, 0, {}
    for s, n in sorted(lengths.items(), key=lambda x: (x[1], x[0])):
        code <<= n - last
        last = n
        out[s] = [(code >> (n - 1 - k)) & 1 for k in range(n)]
        code += 1
    return out if len(lengths) > 1 else {s: [] for s in lengths}


def write_code(w, counts, alphabet, pick):
    """Writes one prefix code and returns its codes."""
    used = sorted(s for s, c in counts.items() if c) or [0]
    if len(used) <= 2 and used[-1] < 256 and pick.random() < 0.8:
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        small = used[0] < 2 and pick.random() < 0.7
        w.put(0 if small else 1, 1)
        w.put(used[0], 1 if small else 8)
        if len(used) == 2:
            w.put(used[1], 8)
        return canonical({s: 1 for s in used})
    lengths = huffman({s: max(1, counts.get(s, 0)) for s in used}, 15)
    row = [lengths.get(s, 0) for s in range(alphabet)]
    end = max(used) + 1
    cut = end >= 2 and pick.random() < 0.5 and any(row[k] != row[0] for k in range(end))
    tokens, k, prev, seq = [], 0, 8, row[:end] if cut else row
    while k < len(seq):
        run = 1
        while k + run < len(seq) and seq[k + run] == seq[k]:
            run += 1
        if seq[k] == 0 and run >= 3:
            run = min(run, 138)
            tokens.append((18, run - 11, 7) if run >= 11 else (17, run - 3, 3))
        elif seq[k] == prev and run >= 3:
            run = min(run, 6)
            tokens.append((16, run - 3, 2))
        else:
            run = 1
            tokens.append((seq[k], 0, 0))
            prev = seq[k] or prev
        k += run
    w.put(0, 1)
    inner = huffman(Counter(t[0] for t in tokens), 7)
    n = max(4, 1 + max(ORDER.index(s) for s in inner))
    w.put(n - 4, 4)
    for s in ORDER[:n]:
        w.put(inner.get(s, 0), 3)
    codes = canonical(inner)
    if cut:
        w.put(1, 1)
        width = 2
        while len(tokens) - 2 >= 1 << width:
            width += 2
        w.put((width - 2) // 2, 3)
        w.put(len(tokens) - 2, width)
    else:
        w.put(0, 1)
    for s, extra, bits in tokens:
        w.code(codes[s])
        w.put(extra, bits)
    return canonical(lengths)


def prefix(value):
    v = value - 1
    if v < 4:
        return v, 0, 0
    high = v.bit_length() - 1
    return 2 * high + ((v >> (high - 1)) & 1), high - 1, v & ((1 << (high - 1)) - 1)


NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y > 0 or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))


def write_image(w, pixels, width, pick, main, cache_bits=0, meta_bits=0):
    """Entropy-codes a list of ARGB numbers."""
    w.put(1 if cache_bits else 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    height = len(pixels) // width
    groups, group_of = 1, lambda p: 0
    if main:
        w.put(1 if meta_bits else 0, 1)
        if meta_bits:
            w.put(meta_bits - 2, 3)
            across = -(-width // (1 << meta_bits))
            down = -(-height // (1 << meta_bits))
            groups = min(3, across * down)
            tiles = [pick.randrange(groups) for _ in range(across * down)]
            tiles[-1] = groups - 1
            write_image(w, [0xFF000000 | t << 8 for t in tiles], across, pick, False)
            group_of = lambda p: tiles[(p // width >> meta_bits) * across + (p % width >> meta_bits)]
    cache, symbols, p = {}, [], 0
    while p < len(pixels):
        best = (0, 0)
        if p and pick.random() < 0.6:
            for far in {1, width, pick.randrange(1, p + 1), pick.randrange(1, p + 1)}:
                n = 0
                while far <= p and p + n < len(pixels) and n < 4096 and pixels[p + n] == pixels[p + n - far]:
                    n += 1
                best = max(best, (n, far))
        px = pixels[p]
        slot = ((px * 0x1E35A7BD) & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
        if best[0] >= 2:
            n, far = best
            choices = [k + 1 for k, (x, y) in enumerate(NEAR) if max(1, x + y * width) == far]
            code = pick.choice(choices) if choices and pick.random() < 0.8 else far + 120
            symbols.append((group_of(p), "copy", prefix(n), prefix(code)))
        elif cache_bits and cache.get(slot, 0) == px:
            n = 1
            symbols.append((group_of(p), "cache", slot))
        else:
            n = 1
            symbols.append((group_of(p), "pixel", px))
        for q in range(p, p + n):
            if cache_bits:
                cache[((pixels[q] * 0x1E35A7BD) & 0xFFFFFFFF) >> (32 - cache_bits)] = pixels[q]
        p += n
    counts = [[Counter() for _ in range(5)] for _ in range(groups)]
    for g, kind, *rest in symbols:
        c = counts[g]
        if kind == "pixel":
            for k, s in enumerate((8, 16, 0, 24)):
                c[k][rest[0] >> s & 255] += 1
        elif kind == "copy":
            c[0][256 + rest[0][0]] += 1
            c[4][rest[1][0]] += 1
        else:
            c[0][280 + rest[0]] += 1
    alphabets = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    codes = [[write_code(w, c[k], alphabets[k], pick) for k in range(5)] for c in counts]
    for g, kind, *rest in symbols:
        c = codes[g]
        if kind == "pixel":
            for k, s in enumerate((8, 16, 0, 24)):
                w.code(c[k][rest[0] >> s & 255])
        elif kind == "copy":
            (s, n, v), (t, m, u) = rest
            w.code(c[0][256 + s])
            w.put(v, n)
            w.code(c[4][t])
            w.put(u, m)
        else:
            w.code(c[0][280 + rest[0]])


def split(px):
    return [px >> 24 & 255, px >> 16 & 255, px >> 8 & 255, px & 255]


def join(parts):
    a, r, g, b = (int(x) & 255 for x in parts)
    return a << 24 | r << 16 | g << 8 | b


def average(a, b):
    return join((x + y) // 2 for x, y in zip(split(a), split(b)))


def clamp(x):
    return max(0, min(255, x))


def guess(mode, pixels, p, width):
    black = 0xFF000000
    if p == 0:
        return black
    left, top = pixels[p - 1], pixels[p - width] if p >= width else None
    if p < width:
        return left
    if p % width == 0:
        return top
    corner, right = pixels[p - width - 1], pixels[p - width + 1]
    if mode == 11:
        near = [x + y - z for x, y, z in zip(split(left), split(top), split(corner))]
        dl = sum(abs(a - b) for a, b in zip(near, split(left)))
        dt = sum(abs(a - b) for a, b in zip(near, split(top)))
        return left if dl < dt else top
    if mode == 12:
        return join(clamp(x + y - z) for x, y, z in zip(split(left), split(top), split(corner)))
    if mode == 13:
        return join(clamp(m + int((m - z) / 2)) for m, z in zip(split(average(left, top)), split(corner)))
    return {
        0: black, 1: left, 2: top, 3: right, 4: corner, 5: average(average(left, right), top), 6: average(left, corner), 7: average(left, top),
        8: average(corner, top), 9: average(top, right), 10: average(average(left, corner), average(top, right)),
    }[mode]


def signed(x):
    return x - 256 if x > 127 else x


def webp(pixels, width, pick, transforms=(), cache_bits=0, meta_bits=0):
    """A file holding ``pixels`` (ARGB numbers, row by row) after the named transforms."""
    height, w, now, wide = len(pixels) // width, Bits(), list(pixels), width
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 1)
    w.put(0, 3)
    for name in transforms:
        w.put(1, 1)
        bits = pick.choice([2, 3])
        across, down = -(-wide // (1 << bits)), -(-height // (1 << bits))
        tile = lambda p: (p // wide >> bits) * across + (p % wide >> bits)  # noqa: B023, E731
        if name == "predictor":
            modes = [pick.randrange(14) for _ in range(across * down)]
            w.put(0, 2)
            w.put(bits - 2, 3)
            write_image(w, [0xFF000000 | m << 8 for m in modes], across, pick, False, pick.choice([0, 2]))
            now = [join(x - y for x, y in zip(split(px), split(guess(modes[tile(p)], now, p, wide)))) for p, px in enumerate(now)]
        elif name == "cross":
            factors = [pick.getrandbits(24) | 0xFF000000 for _ in range(across * down)]
            w.put(1, 2)
            w.put(bits - 2, 3)
            write_image(w, factors, across, pick, False)
            out = []
            for p, px in enumerate(now):
                a, r, g, b = split(px)
                _, red_blue, green_blue, green_red = map(signed, split(factors[tile(p)]))
                out.append(join((a, r - (green_red * signed(g) >> 5), g, b - (green_blue * signed(g) >> 5) - (red_blue * signed(r) >> 5))))
            now = out
        elif name == "green":
            w.put(2, 2)
            now = [join((a, r - g, g, b - g)) for a, r, g, b in map(split, now)]
        else:
            palette = sorted(set(now))
            w.put(3, 2)
            w.put(len(palette) - 1, 8)
            write_image(w, [join(x - y for x, y in zip(split(c), split(palette[k - 1] if k else 0))) for k, c in enumerate(palette)], len(palette), pick, False)
            pack = 3 if len(palette) <= 2 else 2 if len(palette) <= 4 else 1 if len(palette) <= 16 else 0
            each, index = 8 >> pack, {c: k for k, c in enumerate(palette)}
            out = []
            for y in range(height):
                row = [index[c] for c in now[y * wide : (y + 1) * wide]]
                for x in range(0, wide, 1 << pack):
                    out.append(0xFF000000 | sum(v << k * each for k, v in enumerate(row[x : x + (1 << pack)])) << 8)
            now, wide = out, -(-wide // (1 << pack))
    w.put(0, 1)
    write_image(w, now, wide, pick, True, cache_bits, meta_bits)
    data = w.bytes()
    padded = data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", 12 + len(padded)) + b"WEBPVP8L" + struct.pack("<I", len(data)) + padded
