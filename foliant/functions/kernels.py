"""Kernels over grey images as arrays of bytes. Area resizing, Otsu's threshold and the like follow their definitions, not a
library's rounding: expect results within a grey level of others."""

from __future__ import annotations

import zlib

import numpy as np

# Weights of blue, green and red; tests of a region and of a blank one.
BGR = (0.114, 0.587, 0.299)
HASH_MOST, NCC_LEAST, EDGE_LEAST, PROFILE_LEAST, TESTS = 8, 0.92, 0.75, 0.90, 2
BLACK_CHANGE, BLANK_TESTS = 0.1, 1


def gray(img: np.ndarray) -> np.ndarray:
    return img if img.ndim == 2 else np.clip(np.rint(img[..., :3].astype(float) @ BGR), 0, 255).astype(np.uint8)


def crop(img: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The part of an image in a box, cut at its borders."""
    h, w = img.shape[:2]
    x0, y0, x1, y1 = (int(v) for v in box)
    return img[max(0, min(y0, h)) : max(0, min(y1, h)), max(0, min(x0, w)) : max(0, min(x1, w))]


def crop_borders(img: np.ndarray, part: float) -> np.ndarray:
    h, w = img.shape[:2]
    dy, dx = int(h * part), int(w * part)
    return img[dy : h - dy, dx : w - dx]


def _area_weights(n: int, m: int) -> np.ndarray:
    """Row k holds the share of each of n cells in the k-th of m equal parts."""
    edges = np.arange(m + 1) * (n / m)
    lo, hi = np.arange(n), np.arange(1, n + 1)
    over = np.clip(np.minimum(edges[1:, None], hi) - np.maximum(edges[:-1, None], lo), 0, None)
    return over / over.sum(axis=1, keepdims=True)


def resize_area(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Each new pixel the mean of what it covers."""
    return _area_weights(img.shape[0], height) @ img.astype(float) @ _area_weights(img.shape[1], width).T


def _lanczos_weights(n: int, m: int, a: int = 4) -> np.ndarray:
    at = (np.arange(m) + 0.5) * n / m - 0.5
    near = np.floor(at)[:, None] + np.arange(1 - a, a + 1)
    d = at[:, None] - near
    w = np.sinc(d) * np.sinc(d / a) * (np.abs(d) < a)
    out = np.zeros((m, n))
    np.add.at(out, (np.arange(m)[:, None], np.clip(near, 0, n - 1).astype(int)), w / w.sum(axis=1, keepdims=True))
    return out


def resize_lanczos(img: np.ndarray, width: int, height: int) -> np.ndarray:
    values = _lanczos_weights(img.shape[0], height) @ img.astype(float) @ _lanczos_weights(img.shape[1], width).T
    return np.clip(np.rint(values), 0, 255).astype(np.uint8)


def binarize(img: np.ndarray, threshold: int = 128, inclusive: bool = False) -> np.ndarray:
    return np.where(img >= threshold if inclusive else img > threshold, 255, 0).astype(np.uint8)


def otsu(img: np.ndarray) -> int:
    """The threshold that parts grey levels with the greatest variance between."""
    p = np.bincount(np.clip(np.rint(img), 0, 255).astype(np.uint8).ravel(), minlength=256) / img.size
    below, mean = np.cumsum(p), np.cumsum(p * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num((mean[-1] * below - mean) ** 2 / (below * (1 - below)))
    return int(np.argmax(between))


def blur3(img: np.ndarray) -> np.ndarray:
    """Weights 1 2 1 over rows and columns, borders mirrored without the edge."""
    p = np.pad(img.astype(float), 1, mode="reflect" if min(img.shape) > 1 else "edge")
    rows = (p[:-2] + 2 * p[1:-1] + p[2:]) / 4
    return (rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:]) / 4


def checksum(img: np.ndarray, size: int = 64) -> int:
    small = blur3(resize_area(gray(img), size, size))
    return zlib.crc32(binarize(small, otsu(small)).tobytes())


def black_pixels(img: np.ndarray, threshold: int = 10) -> int:
    return int((img < threshold).sum())


def components(img: np.ndarray) -> int:
    """Connected groups of pixels other than 0, over edges and corners: runs of rows joined by union and find."""
    root: list[int] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    above: list[tuple[int, int, int]] = []
    for row in img != 0:
        edges = np.flatnonzero(np.diff(np.concatenate([[0], row.view(np.int8), [0]])))
        runs, k = [], 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            own = len(root)
            root.append(own)
            while k < len(above) and above[k][1] < a:
                k += 1
            j = k
            while j < len(above) and above[j][0] <= b:
                root[find(above[j][2])] = find(own)
                j += 1
            runs.append((a, b, own))
        above = runs
    return sum(root[x] == x for x in range(len(root)))


def _dct(n: int) -> np.ndarray:
    k = np.arange(n)
    m = np.cos(np.pi * (2 * k[None] + 1) * k[:, None] / (2 * n)) * np.sqrt(2 / n)
    m[0] /= np.sqrt(2)
    return m


def phash(img: np.ndarray, size: int = 8, dct: int = 32, border: float = 0.0, median_of: str = "all_but_first") -> int:
    """Signs of the low frequencies against their median, as a signed number of 64 bits, the first lowest.

    The median is of all but the first coefficient, or of those outside the first row and column (`inner`).
    """
    g = gray(crop_borders(img, border) if border else img)
    m = _dct(dct)
    low = (m @ resize_area(g, dct, dct) @ m.T)[:size, :size]
    values = low[1:, 1:].ravel() if median_of == "inner" else low.ravel()[1:]
    bits = (low > np.median(values)).ravel()
    return int(np.packbits(bits, bitorder="little").view("<i8")[0]) if size == 8 else int(sum(1 << k for k, b in enumerate(bits) if b))


def ncc(a: np.ndarray, b: np.ndarray) -> float:
    """Correlation of two patches of one size; 0 if one is flat."""
    x, y = a.astype(float) - a.mean(), b.astype(float) - b.mean()
    scale = np.sqrt((x * x).sum() * (y * y).sum())
    return float((x * y).sum() / scale) if scale > 1e-9 else 0.0


def edges(img: np.ndarray, low: float = 100, high: float = 200) -> np.ndarray:
    """Edges by gradient, thinned along it, kept above `high` or, above `low`, beside kept ones."""
    p = np.pad(img.astype(float), 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    size = np.abs(gx) + np.abs(gy)
    turn = (np.rint(np.arctan2(gy, gx) / (np.pi / 4)).astype(int)) % 4
    q = np.pad(size, 1)
    ahead = {0: (1, 2), 1: (2, 2), 2: (2, 1), 3: (2, 0)}
    keep = np.zeros(size.shape, dtype=bool)
    h, w = size.shape
    for t, (dy, dx) in ahead.items():
        keep |= (turn == t) & (size > q[2 - dy : 2 - dy + h, 2 - dx : 2 - dx + w]) & (size >= q[dy : dy + h, dx : dx + w])
    weak, strong = keep & (size > low), keep & (size > high)
    while True:
        s = np.pad(strong, 1)
        near = np.zeros_like(strong)
        for dy in range(3):
            for dx in range(3):
                near |= s[dy : dy + h, dx : dx + w]
        grown = weak & near
        if (grown == strong).all():
            return strong
        strong = grown


def edge_iou(a: np.ndarray, b: np.ndarray) -> float:
    x, y = edges(a), edges(b)
    either = (x | y).sum()
    return float((x & y).sum() / either) if either else 1.0


def profile(img: np.ndarray, axis: int = 0, most: int = 256) -> np.ndarray:
    """Sums along an axis, shortened to `most` means, with mean 0 and deviation 1."""
    sums = gray(img).astype(float).sum(axis=axis)
    if len(sums) > most:
        sums = _area_weights(len(sums), most) @ sums
    return (sums - sums.mean()) / (sums.std() + 1e-9)


def profile_ncc(a: np.ndarray, b: np.ndarray) -> float:
    n = min(len(a), len(b))
    x, y = (v[(len(v) - n) // 2 :][:n] for v in (a, b))
    return float((x * y).mean()) if n else 0.0


def locate(patch: np.ndarray, template: np.ndarray, threshold: float = 0.7) -> tuple[bool, int, int, float]:
    """(found, x, y, score) of the place in a patch that correlates best with a template; sums by the Fourier transform."""
    a, t = patch.astype(float), template.astype(float)
    th, tw = t.shape
    if a.shape[0] < th or a.shape[1] < tw or t.std() < 1e-9:
        return False, 0, 0, 0.0
    t = t - t.mean()
    shape = (a.shape[0] + th - 1, a.shape[1] + tw - 1)
    conv = lambda x, y: np.fft.irfft2(np.fft.rfft2(x, shape) * np.fft.rfft2(y, shape), shape)[th - 1 : a.shape[0], tw - 1 : a.shape[1]]
    ones = np.ones_like(t)
    sums, squares = conv(a, ones), conv(a * a, ones)
    var = np.maximum(squares - sums**2 / t.size, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(var > 1e-6, conv(a, t[::-1, ::-1]) / np.sqrt(var * (t * t).sum()), 0.0)
    y, x = np.unravel_index(int(np.argmax(score)), score.shape)
    best = float(score[y, x])
    return best >= threshold, int(x), int(y), best


def match_descriptors(a: np.ndarray, b: np.ndarray, cross_check: bool = True, ratio: float | None = None, most: int | None = None) -> list[tuple[int, int, int]]:
    """(row of a, row of b, distance) of nearest binary descriptors: mutual, and by Lowe's ratio of the best to the second."""
    if not len(a) or not len(b):
        return []
    d = np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int32)
    best, back = d.argmin(axis=1), d.argmin(axis=0)
    out = []
    for i, j in enumerate(best):
        if cross_check and back[j] != i:
            continue
        if ratio is not None and d.shape[1] > 1 and d[i, j] >= ratio * np.partition(d[i], 1)[1]:
            continue
        if most is None or d[i, j] < most:
            out.append((i, int(j), int(d[i, j])))
    return out


def fit_affine(src: np.ndarray, dst: np.ndarray, rounds: int = 200, within: float = 3.0, seed: int = 42) -> tuple[np.ndarray | None, np.ndarray]:
    """A 2 x 3 matrix of shift, rotation and scale, and which points it moves near their partners; by seeded sampling of pairs."""
    n = len(src)
    if n < 2:
        return None, np.zeros(n, dtype=bool)
    z, w = src[:, 0] + 1j * src[:, 1], dst[:, 0] + 1j * dst[:, 1]
    rng, best = np.random.default_rng(seed), np.zeros(n, dtype=bool)
    for _ in range(rounds):
        i, j = rng.choice(n, 2, replace=False)
        if z[i] == z[j]:
            continue
        m = (w[j] - w[i]) / (z[j] - z[i])
        near = np.abs(m * (z - z[i]) + w[i] - w) < within
        if near.sum() > best.sum():
            best = near
    if best.sum() < 2:
        return None, best
    zc, wc = z[best].mean(), w[best].mean()
    m = np.vdot(z[best] - zc, w[best] - wc) / np.vdot(z[best] - zc, z[best] - zc)
    t = wc - m * zc
    return np.array([[m.real, -m.imag, t.real], [m.imag, m.real, t.imag]]), best


def region_matches(a: np.ndarray, b: np.ndarray, tests: int = TESTS, size: int = 128) -> tuple[bool, dict[str, float]]:
    """Whether two regions pass enough of five tests: checksum, hash, correlation, edges, both profiles."""
    x, y = (np.clip(np.rint(resize_area(gray(v), size, size)), 0, 255).astype(np.uint8) for v in (a, b))
    got = {
        "crc": float(checksum(x) == checksum(y)),
        "hash": float(((phash(x) ^ phash(y)) & 0xFFFFFFFFFFFFFFFF).bit_count()),
        "ncc": ncc(x, y),
        "edges": edge_iou(x, y),
        "rows": profile_ncc(profile(x, 1), profile(y, 1)),
        "columns": profile_ncc(profile(x, 0), profile(y, 0)),
    }
    passed = (got["crc"] == 1) + (got["hash"] <= HASH_MOST) + (got["ncc"] >= NCC_LEAST) + (got["edges"] >= EDGE_LEAST) + (min(got["rows"], got["columns"]) >= PROFILE_LEAST)
    return passed >= tests, got


def blank_matches(black_a: int, black_b: int, parts_a: int, parts_b: int, tests: int = BLANK_TESTS) -> bool:
    """Whether a region is as blank as its template: black pixels within a tenth, or as many components."""
    near = abs(black_a - black_b) <= BLACK_CHANGE * max(black_b, 1)
    return int(near) + int(parts_a == parts_b) >= tests


def fill(img: np.ndarray, pts: np.ndarray, color: int = 0, inside: np.ndarray | None = None) -> np.ndarray:
    """A copy with a convex polygon filled, only within a mask if one is given."""
    out = img.copy()
    out[polygon_mask(img.shape[:2], pts) & (True if inside is None else inside)] = color
    return out


def polygon_mask(shape: tuple[int, int], pts: np.ndarray) -> np.ndarray:
    """Pixels whose centres lie in a convex polygon, borders included."""
    ys, xs = np.mgrid[: shape[0], : shape[1]]
    p, q = np.asarray(pts, float), np.roll(np.asarray(pts, float), -1, axis=0)
    side = [(b[0] - a[0]) * (ys - a[1]) - (b[1] - a[1]) * (xs - a[0]) for a, b in zip(p, q, strict=True)]
    return np.all([s >= 0 for s in side], axis=0) | np.all([s <= 0 for s in side], axis=0)


def stripes(img: np.ndarray, pts: np.ndarray, thickness: float = 0.1, spacing: float = 0.5, color: int = 0) -> np.ndarray:
    """A copy with stripes across a quadrilateral: each a part of its height, apart by a multiple of that."""
    p = np.asarray(pts, float)
    down = p[3] - p[0]
    tall = float(np.hypot(*down))
    if tall == 0:
        return img.copy()
    ys, xs = np.mgrid[: img.shape[0], : img.shape[1]]
    along = ((xs - p[0][0]) * down[0] + (ys - p[0][1]) * down[1]) / tall
    width = max(1.0, thickness * tall)
    out = img.copy()
    out[polygon_mask(img.shape[:2], p) & (along % (width * (1 + spacing)) < width)] = color
    return out


def white(width: int, height: int) -> np.ndarray:
    """What stands for an image that can't be decoded; one smaller than 100 pixels on a side becomes 100 by 100."""
    w, h = (width, height) if width >= 100 and height >= 100 else (100, 100)
    return np.full((h, w), 255, dtype=np.uint8)


def crop_masked(img: np.ndarray, pts: np.ndarray) -> np.ndarray:
    """The upright part of an image around a convex polygon, black outside it."""
    h, w = img.shape[:2]
    p = np.asarray(pts, float)
    x0, y0, x1, y1 = max(int(np.floor(p[:, 0].min())), 0), max(int(np.floor(p[:, 1].min())), 0), min(int(np.ceil(p[:, 0].max())), w), min(int(np.ceil(p[:, 1].max())), h)
    mask = polygon_mask((h, w), p)
    return np.where(mask if img.ndim == 2 else mask[..., None], img, 0)[y0:y1, x0:x1]


def perspective(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The 3 x 3 matrix that takes four points to four others."""
    rows = []
    for (x, y), (u, v) in zip(src, dst, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
    return np.append(np.linalg.solve(np.array(rows, float), np.asarray(dst, float).ravel()), 1.0).reshape(3, 3)


def crop_warped(img: np.ndarray, pts: np.ndarray, size: tuple[int, int] | None = None) -> np.ndarray:
    """A quadrilateral, from its top left corner clockwise, made upright by perspective, with values between pixels from the four
    around. Its size is that of its longer sides if none is given."""
    p = np.asarray(pts, float)
    side = lambda a, b: float(np.hypot(*(p[a] - p[b])))
    w, h = size or (max(1, round(max(side(0, 1), side(3, 2)))), max(1, round(max(side(0, 3), side(1, 2)))))
    m = perspective(np.array([(0, 0), (w - 1, 0), (w - 1, h - 1), (0, h - 1)], float) if w > 1 and h > 1 else np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float), p)
    ys, xs = np.mgrid[:h, :w]
    u, v, z = (m[k, 0] * xs + m[k, 1] * ys + m[k, 2] for k in range(3))
    u, v = u / z, v / z
    x0, y0 = np.floor(u).astype(int), np.floor(v).astype(int)
    out = 0.0
    for dy in (0, 1):
        for dx in (0, 1):
            x, y = x0 + dx, y0 + dy
            inside = (x >= 0) & (x < img.shape[1]) & (y >= 0) & (y < img.shape[0])
            weight = (1 - np.abs(u - x)) * (1 - np.abs(v - y)) * inside
            value = img[np.clip(y, 0, img.shape[0] - 1), np.clip(x, 0, img.shape[1] - 1)].astype(float)
            out = out + (value * weight if img.ndim == 2 else value * weight[..., None])
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)
