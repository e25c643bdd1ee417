"""Page preparation against brute force: flood fill, loops over points, and pages that are drawn."""

import numpy as np
import pytest

from polyglossa.functions import images


def flood(mask, diagonal):
    """Labels of a mask's components by flood fill."""
    label, n = np.zeros(mask.shape, int), 0
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    for y, x in zip(*np.nonzero(mask), strict=True):
        if label[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        label[y, x] = n
        while todo:
            a, b = todo.pop()
            for dy, dx in steps:
                c, d = a + dy, b + dx
                if 0 <= c < mask.shape[0] and 0 <= d < mask.shape[1] and mask[c, d] and not label[c, d]:
                    label[c, d] = n
                    todo.append((c, d))
    return label


def boxes_by_flood(mask):
    """Boxes of the components that touch the background around the page."""
    wide = np.pad(mask, 1)
    outside = flood(~wide, False) == flood(~wide, False)[0, 0]
    label, out = flood(wide, True), []
    for n in range(1, label.max() + 1):
        own = np.pad(label == n, 1)
        beside = (own[:-2, 1:-1] | own[2:, 1:-1] | own[1:-1, :-2] | own[1:-1, 2:]) & outside & ~wide
        if beside.any():
            y, x = np.nonzero(label == n)
            out.append((x.min() - 1, y.min() - 1, np.ptp(x) + 1, np.ptp(y) + 1))
    return sorted(map(tuple, np.array(out).reshape(-1, 4).tolist()))


@pytest.mark.parametrize("share", [0.2, 0.4, 0.55, 0.7, 0.9])
def test_boxes_equal_flood_fill(share):
    rng = np.random.default_rng(int(share * 100))
    for _ in range(40):
        mask = rng.random(rng.integers(1, 24, 2)) < share
        assert sorted(map(tuple, images.outer_boxes(mask).tolist())) == boxes_by_flood(mask)
    ring = np.zeros((9, 9), bool)
    ring[1:8, 1:8] = True
    ring[2:7, 2:7] = False
    ring[4, 4] = True
    assert images.outer_boxes(ring).tolist() == [[1, 1, 7, 7]]  # what the ring encloses is none of its own


def test_dilation():
    rng = np.random.default_rng(1)
    for w, h in ((1, 1), (3, 3), (4, 2), (25, 3)):
        mask = rng.random((17, 31)) < 0.05
        want = np.zeros_like(mask)
        for y in range(17):
            for x in range(31):
                ys, xs = [y - h // 2 + k for k in range(h)], [x - w // 2 + k for k in range(w)]
                want[y, x] = any(mask[a, b] for a in ys for b in xs if 0 <= a < 17 and 0 <= b < 31)
        assert (images.dilated(mask, w, h) == want).all()


def page(lines, height=600, width=420, frame=False):
    gray = np.full((height, width), 230, np.uint8)
    for y, n in lines:
        gray[y : y + 10, 30 : 30 + n : 2] = 20
    if frame:
        gray[5:9, 5:-5] = gray[-9:-5, 5:-5] = 20
        gray[5:-5, 5:9] = gray[5:-5, -9:-5] = 20
    return gray


def test_crop():
    lines = [(100 + 40 * k, 300) for k in range(8)]
    gray = page([(10, 300), *lines, (580, 300), (500, 30)])  # an ornament at each edge, and a short box below
    assert (images.cropped(gray) == gray[99 - 12 : 391 + 15]).all()
    assert images.cropped(page(lines[:2])).shape == (600, 420)  # two lines are too few
    assert images.cropped(page([(y, 300) for y in (100, 130, 160)])).shape == (600, 420)  # and these too low
    assert images.cropped(page(lines, frame=True)).shape == (600, 420)  # a closed frame hides what it encloses
    assert images.cropped(np.full((50, 60), 255, np.uint8)).shape == (50, 60)


def test_noise():
    rng = np.random.default_rng(2)
    g = rng.integers(0, 60, (9, 11)).astype(np.uint8)
    patch, search, strength = 3, 5, 20.0
    wide = np.pad(g.astype(float), 3, mode="reflect")
    for y in range(9):
        for x in range(11):
            total = weights = 0.0
            for dy in range(-2, 3):
                for dx in range(-2, 3):
                    a, b = (wide[3 + y + v - 1 : 3 + y + v + 2, 3 + x + u - 1 : 3 + x + u + 2] for v, u in ((0, 0), (dy, dx)))
                    k = np.exp(-((a - b) ** 2).mean() / strength**2)
                    total, weights = total + k * wide[3 + y + dy, 3 + x + dx], weights + k
            assert abs(images.denoised(g, strength, patch, search)[y, x] - total / weights) <= 0.51


def test_contrast():
    rng = np.random.default_rng(3)
    g = rng.normal(120, 20, (21, 26)).clip(0, 255).astype(np.uint8)
    tiles, th, tw = 4, 6, 7
    wide = np.pad(g, ((0, 3), (0, 2)), mode="reflect")
    limit, tables = max(int(2.0 * th * tw / 256), 1), {}
    for i in range(tiles):
        for j in range(tiles):
            count = [0] * 256
            for v in wide[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel():
                count[v] += 1
            excess = sum(max(c - limit, 0) for c in count)
            count = [min(c, limit) + excess // 256 for c in count]
            left = excess % 256
            for k in range(left):
                count[k * max(256 // left, 1)] += 1
            run, tables[i, j] = 0, []
            for c in count:
                run += c
                tables[i, j].append(min(round(run * 255 / (th * tw)), 255))
    got = images.equalised(g, 2.0, tiles)
    for y in range(21):
        for x in range(26):
            v, u = y / th - 0.5, x / tw - 0.5
            i, j = int(np.floor(v)), int(np.floor(u))
            fit = lambda k: min(max(k, 0), tiles - 1)
            at = lambda a, b: tables[fit(a), fit(b)][g[y, x]]  # noqa: B023, E731
            want = (at(i, j) * (1 - u + j) + at(i, j + 1) * (u - j)) * (1 - v + i) + (at(i + 1, j) * (1 - u + j) + at(i + 1, j + 1) * (u - j)) * (v - i)
            assert abs(got[y, x] - want) <= 0.51


def test_png_round_trip_and_filters():
    import struct
    import zlib

    rng = np.random.default_rng(4)
    g = rng.integers(0, 256, (7, 9)).astype(np.uint8)
    assert (images.read_png(images.write_png(g)) == g).all()
    rgb = rng.integers(0, 256, (5, 6, 3)).astype(np.uint8)
    body, above = b"", np.zeros(18, int)
    for y, method in enumerate(range(5)):  # each row by another filter
        line = rgb[y].ravel().astype(int)
        left, corner = np.r_[0, 0, 0, line[:-3]], np.r_[0, 0, 0, above[:-3]]
        p = left + above - corner
        near = [min(((abs(q - v), k, v) for k, v in enumerate(t)))[2] for q, t in zip(p, zip(left, above, corner, strict=True), strict=True)]
        guess = (0 * line, left, above, (left + above) // 2, np.array(near))[method]
        body, above = body + bytes([method]) + ((line - guess) % 256).astype(np.uint8).tobytes(), line
    chunk = lambda kind, part: struct.pack(">I", len(part)) + kind + part + struct.pack(">I", zlib.crc32(kind + part))
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 5, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")
    assert (images.read_png(data) == images.grey(rgb)).all()
    with pytest.raises(ValueError, match="PNG"):
        images.read_png(b"GIF89a")


def test_prepared_page():
    out = images.prepared(page([(100 + 40 * k, 300) for k in range(8)])[::1])
    assert out.dtype == np.uint8 and out.shape[1] == 420 - 2 * 15 and out.shape[0] < 400 and out.min() < 60 < 200 < out.max()
    assert (images.stretched(np.array([[10, 20, 30]], np.uint8)) == [[0, 128, 255]]).all()
