"""Grey pages as numpy arrays: text lines as connected components, crops, contrast and noise before recognition.

Everything here is a helper for one page; sources/recognition.py applies it to a table of pages.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Shares of a page, sizes in pixels and strengths that recognition was tuned for.
MARGIN = 0.035
JOIN_LEAST, JOIN_SHARE, JOIN_ROWS = 25, 42, 3
EDGE_TOP, EDGE_BOTTOM, LINE_WIDTH, LINE_LEAST, LINE_SHARE = 0.05, 0.96, 0.18, 8, 0.045
LEAST_LINES, PAD_TOP, PAD_BOTTOM, LEAST_HEIGHT = 3, 0.02, 0.025, 0.35
DENOISE_STRENGTH, DENOISE_PATCH, DENOISE_SEARCH = 5.0, 7, 21
CLIP, TILES = 2.0, 8

_PNG = b"\x89PNG\r\n\x1a\n"


def read_png(data: bytes) -> np.ndarray:
    """The grey values of a PNG of 8 bits a channel, not interlaced; alpha is left out."""
    if data[:8] != _PNG:
        raise ValueError("not a PNG")
    at, body = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, bits, color, _, _, interlaced = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += n + 12
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if bits != 8 or interlaced or channels is None:
        raise ValueError("only PNGs of 8 bits a channel without palette and interlacing are read")
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out, above = np.empty((h, w, channels), np.uint8), np.zeros((w, channels), np.uint8)
    for y in range(h):
        method, line = rows[y, 0], rows[y, 1:].reshape(w, channels)
        if method == 0:
            out[y] = line
        elif method == 1:
            out[y] = np.cumsum(line, axis=0, dtype=np.uint8)
        elif method == 2:
            out[y] = line + above
        else:
            left = corner = np.zeros(channels, int)
            for x in range(w):
                up = above[x].astype(int)
                if method == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (line[x] + guess) % 256, up
                out[y, x] = left
        above = out[y]
    return grey(out[..., :3]) if channels >= 3 else out[..., 0].copy()


def write_png(gray: np.ndarray) -> bytes:
    chunk = lambda kind, part: struct.pack(">I", len(part)) + kind + part + struct.pack(">I", zlib.crc32(kind + part))
    h, w = gray.shape
    body = zlib.compress(np.hstack([np.zeros((h, 1), np.uint8), gray.astype(np.uint8)]).tobytes(), 6)
    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def grey(rgb: np.ndarray) -> np.ndarray:
    return np.floor(rgb.astype(np.float64) @ [0.299, 0.587, 0.114] + 0.5).astype(np.uint8)


def ink_level(gray: np.ndarray) -> int:
    """Otsu's level, the first of equal ones: ink is what is not above it. 0 for a page of one value."""
    count = np.bincount(gray.ravel(), minlength=256).astype(float)
    below, mean = np.cumsum(count), np.cumsum(count * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = (mean[-1] * below / below[-1] - mean) ** 2 / (below * (below[-1] - below))
    spread = np.where(np.isfinite(spread), spread, 0)
    return int(np.argmax(spread >= spread.max() * (1 - 1e-9))) if spread.max() > 0 else 0


def dilated(mask: np.ndarray, width: int, height: int) -> np.ndarray:
    """The mask with every point grown to a rectangle of that size around it."""
    for n in (height, width):
        # each place sees a window about it; windows of twice the size are two of them together
        mask, reach = np.pad(mask, ((n // 2, n - 1 - n // 2), (0, 0))), 1
        while reach < n:
            step = min(reach, n - reach)
            mask, reach = mask[:-step] | mask[step:], reach + step
        mask = mask.T
    return mask


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of the runs of a mask, row by row."""
    wide = np.pad(mask, ((0, 0), (1, 1)))
    at = np.flatnonzero(wide[:, 1:] != wide[:, :-1])  # a row has as many beginnings as ends, in turn
    row, first = np.divmod(at[::2], mask.shape[1] + 1)
    return row, first, at[1::2] % (mask.shape[1] + 1)


def labels_of(runs: tuple[np.ndarray, np.ndarray, np.ndarray], width: int, diagonal: bool) -> np.ndarray:
    """A label a run: the smallest number of a run that it is connected with, over corners too if `diagonal`."""
    row, first, end = runs
    reach = int(diagonal)
    # the runs of the row above that a run touches stand together
    lo = np.searchsorted(row * (width + 2) + end, (row - 1) * (width + 2) + first - reach, side="right")
    hi = np.searchsorted(row * (width + 2) + first, (row - 1) * (width + 2) + end + reach, side="left")
    n = np.maximum(hi - lo, 0)
    b = np.repeat(np.arange(len(row)), n)
    a = np.arange(len(b)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    label = np.arange(len(row))
    while True:
        low = label.copy()
        np.minimum.at(low, label[a], label[b])
        np.minimum.at(low, label[b], label[a])
        while (jump := low[low]).tolist() != low.tolist():
            low = jump
        low = low[label]
        if (low == label).all():
            return label
        label = low


def outer_boxes(mask: np.ndarray) -> np.ndarray:
    """(x, y, w, h) of the components of a mask (corners connect) that no other component encloses, by their first run."""
    h, w = mask.shape
    if not mask.any():
        return np.empty((0, 4), np.int64)
    runs = row, first, end = runs_of(mask)
    label = labels_of(runs, w, True)
    # what lies outside is the background that reaches the edge of the page; it does not pass between touching corners
    ground = runs_of(np.pad(~mask, 1, constant_values=True))
    outside = labels_of(ground, w + 2, False) == 0
    sky = np.zeros((h + 2, w + 3), np.int32)
    np.add.at(sky, (ground[0][outside], ground[1][outside]), 1)
    np.add.at(sky, (ground[0][outside], ground[2][outside]), -1)
    sky = np.cumsum(np.cumsum(sky, axis=1), axis=1)  # outside points of a row up to and with each
    above = lambda r: sky[r, end] - sky[r, first] > 0  # noqa: E731  a run's columns are first + 1..end in the padded page
    near = np.zeros((h + 2, w + 2), bool)
    near[:, 0] = sky[:, 0] > 0
    near[:, 1:] = np.diff(sky[:, : w + 2], axis=1) > 0
    free = near[row + 1, first] | near[row + 1, end + 1] | above(row) | above(row + 2)
    ids, inverse = np.unique(label, return_inverse=True)
    least = lambda v: np.minimum.reduceat(v[order], start)
    order = np.argsort(inverse, kind="stable")
    start = np.searchsorted(inverse[order], np.arange(len(ids)))
    x, y, right, bottom = least(first), least(row), -least(-end), -least(-row) + 1
    is_free = -least(-free.astype(np.int8)) > 0
    return np.stack([x, y, right - x, bottom - y], axis=1)[is_free]


def joined_boxes(gray: np.ndarray) -> np.ndarray:
    """Boxes of the page's components after letters that stand near have been joined to lines."""
    return outer_boxes(dilated(gray <= ink_level(gray), max(JOIN_LEAST, gray.shape[1] // JOIN_SHARE), JOIN_ROWS))


def is_line(x, y, w, h, width, height):
    """Whether a box is a line of print: no ornament at the upper or lower edge, wide and low. For numbers and for columns."""
    return (y >= height * EDGE_TOP) & (y + h <= height * EDGE_BOTTOM) & (w >= width * LINE_WIDTH) & (h >= LINE_LEAST) & (h <= height * LINE_SHARE)


def cropped(gray: np.ndarray) -> np.ndarray:
    """The rows of a page from its first to its last line of print; the page itself if that is too little."""
    h, w = gray.shape
    boxes = joined_boxes(gray)
    boxes = boxes[is_line(*boxes.T, w, h)]
    if len(boxes) < LEAST_LINES:
        return gray
    top = max(0, int(boxes[:, 1].min()) - round(h * PAD_TOP))
    bottom = min(h, int((boxes[:, 1] + boxes[:, 3]).max()) + round(h * PAD_BOTTOM))
    return gray if bottom - top < h * LEAST_HEIGHT else gray[top:bottom]


def stretched(gray: np.ndarray) -> np.ndarray:
    """Values spread over 0..255; a page of one value becomes black."""
    lo, hi = int(gray.min()), int(gray.max())
    return np.rint((gray.astype(np.float64) - lo) * (255 / (hi - lo) if hi > lo else 0)).astype(np.uint8)


def denoised(gray: np.ndarray, strength: float = DENOISE_STRENGTH, patch: int = DENOISE_PATCH, search: int = DENOISE_SEARCH) -> np.ndarray:
    """Non-local means: every point is the mean of the points around it, weighted by how alike their patches are.

    For each shift of the search window the squared differences of all points are added up over patches by running sums,
    so a shift costs the same whatever the size of a patch. Edges are mirrored without their last line.
    """
    r, s = patch // 2, search // 2
    wide = np.pad(gray.astype(np.float64), r + s, mode="reflect" if min(gray.shape) > 1 else "edge")
    h, w = gray.shape
    own = wide[s : s + h + 2 * r, s : s + w + 2 * r]
    total, weights = np.zeros((h, w)), np.zeros((h, w))
    for dy in range(search):
        for dx in range(search):
            other = wide[dy : dy + h + 2 * r, dx : dx + w + 2 * r]
            d = np.pad(np.cumsum(np.cumsum((own - other) ** 2, axis=0), axis=1), ((1, 0), (1, 0)))
            apart = (d[patch:, patch:] - d[:-patch, patch:] - d[patch:, :-patch] + d[:-patch, :-patch]) / patch**2
            weight = np.exp(-np.maximum(apart, 0) / strength**2)
            total += weight * other[r : r + h, r : r + w]
            weights += weight
    return np.rint(total / weights).astype(np.uint8)


def equalised(gray: np.ndarray, clip: float = CLIP, tiles: int = TILES) -> np.ndarray:
    """Contrast by the histograms of tiles, clipped and their excess spread, with tables interpolated between tile centres."""
    h, w = gray.shape
    wide = np.pad(gray, ((0, -h % tiles), (0, -w % tiles)), mode="reflect" if min(h, w) > tiles else "edge")
    th, tw = wide.shape[0] // tiles, wide.shape[1] // tiles
    tables = np.empty((tiles, tiles, 256))
    limit = max(int(clip * th * tw / 256), 1)
    for i in range(tiles):
        for j in range(tiles):
            count = np.bincount(wide[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            excess = int(np.maximum(count - limit, 0).sum())
            count = np.minimum(count, limit) + excess // 256
            if left := excess % 256:
                count[np.arange(0, 256, max(256 // left, 1))[:left]] += 1
            tables[i, j] = np.minimum(np.rint(np.cumsum(count) * (255 / (th * tw))), 255)
    place = lambda n, size: np.arange(n) / size - 0.5
    y, x = place(h, th), place(w, tw)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    inside = lambda v: np.clip(v, 0, tiles - 1)
    at = lambda a, b: tables[inside(a)[:, None], inside(b)[None, :], gray]
    out = (at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx) * fy
    return np.rint(out).astype(np.uint8)


def prepared(gray: np.ndarray) -> np.ndarray:
    """A page without its margins, cropped to its print, spread, without noise, with even contrast."""
    h, w = gray.shape
    y, x = round(h * MARGIN), round(w * MARGIN)
    return equalised(denoised(stretched(cropped(gray[y : h - y, x : w - x]))))
