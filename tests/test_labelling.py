import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import png
from tessera.functions.labelling import Options, boxes, components, label_line


def flood(mask, connectivity):
    """Components by an independent flood fill."""
    left = {(int(y), int(x)) for y, x in zip(*np.nonzero(mask))}
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (connectivity == 8 or not (a and b))]
    out = []
    while left:
        todo, seen = [left.pop()], []
        while todo:
            y, x = todo.pop()
            seen.append((y, x))
            for a, b in near:
                if (y + a, x + b) in left:
                    left.remove((y + a, x + b))
                    todo.append((y + a, x + b))
        ys, xs = [p[0] for p in seen], [p[1] for p in seen]
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(seen)))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 14), st.integers(1, 14), st.randoms(use_true_random=False), st.sampled_from([4, 8]), st.floats(0.1, 0.9))
def test_components_equal_a_flood_fill(height, width, rng, connectivity, density):
    mask = np.array([[rng.random() < density for _ in range(width)] for _ in range(height)], np.uint8)
    assert sorted(map(tuple, components(mask, connectivity).tolist())) == flood(mask, connectivity)


@pytest.mark.parametrize("shape", ["ring", "spiral", "checkerboard", "many"])
def test_shapes(shape):
    mask = np.zeros((41, 41), np.uint8)
    if shape == "ring":
        mask[5:30, 5:30] = 1
        mask[10:20, 10:20] = 0
        mask[14, 14] = 1
    elif shape == "spiral":
        for k in range(0, 20, 4):
            mask[k, k : 41 - k] = mask[k : 41 - k, 40 - k] = mask[40 - k, k : 41 - k] = mask[k + 2 : 41 - k, k] = 1
    elif shape == "checkerboard":
        mask[(np.indices(mask.shape).sum(0) % 2) == 0] = 1
    else:
        mask[::2, ::2] = 1
    for c in (4, 8):
        assert sorted(map(tuple, components(mask, c).tolist())) == flood(mask, c)


def found(mask, **options):
    got = boxes(mask, Options(**options))
    return [(b["x"], b["y"], b["w"], b["h"]) for b in got["boxes"]], got


def test_box_fixtures():
    two = np.zeros((100, 200), np.uint8)
    two[10:30, 20:60] = two[80:90, 150:160] = 1
    b, got = found(two)
    assert b == [(20, 10, 40, 20), (150, 80, 10, 10)] and got["boxes"][0]["line"] == "0 0.2000000000 0.2000000000 0.2000000000 0.2000000000"
    assert found(two, mode="union")[0] == [(20, 10, 140, 80)]
    corner = np.zeros((100, 200), np.uint8)
    corner[99, 199] = 1
    assert found(corner)[1]["boxes"][0]["line"] == "0 0.9975000000 0.9950000000 0.0050000000 0.0100000000"
    assert found(np.ones((100, 200), np.uint8))[1]["boxes"][0]["line"] == "0 0.5000000000 0.5000000000 1.0000000000 1.0000000000"
    small = np.zeros((10, 10), np.uint8)
    small[:2, :2] = 1
    assert found(small, padding=100)[0] == [(0, 0, 10, 10)]
    small[9, 9] = 1
    b, got = found(small, padding=100)
    assert b == [(0, 0, 10, 10)] and got["duplicate_boxes"] == 1
    least = np.zeros((20, 20), np.uint8)
    least[1, 1] = least[10:13, 10:13] = 1
    b, got = found(least, min_area=2)
    assert b == [(10, 10, 3, 3)] and (got["components"], got["removed_components"], got["removed_pixels"]) == (2, 1, 1)
    near = np.zeros((5, 5), np.uint8)
    near[1, 1], near[2, 2] = 1, 6
    assert len(found(near)[0]) == 1 and len(found(near, connectivity=4)[0]) == 2
    b, got = found(np.zeros((10, 10), np.uint8))
    assert b == [] and got["components"] == 0


def test_errors_and_exact_decimals():
    with pytest.raises(ValueError):
        label_line(99, 0, 2, 3, 100, 100)
    for bad in ({"mode": "x"}, {"min_area": 0}, {"padding": -1}, {"connectivity": 6}):
        with pytest.raises(ValueError):
            Options(**bad)
    assert label_line(1986, 0, 761, 10, 5120, 100).split()[1] == "0.4622070313" or label_line(1986, 0, 761, 10, 5120, 100).split()[1] == f"{(1986 + 761 / 2) / 5120:.10f}"


def test_png_masks():
    low = np.arange(7, dtype=np.uint8)[None, :]
    mask, values = png.mask(png.encode(low))
    assert values == list(range(7)) and mask.tolist() == [[0, 1, 1, 1, 1, 1, 1]]
    index = np.zeros((10, 12), np.uint8)
    index[7, 6] = 1
    mask, values = png.mask(png.encode(index, palette=b"\xff\xff\xff\0\0\0"))
    assert values == [0, 1] and mask.sum() == 1 and mask[7, 6] == 1
    grey = np.zeros((10, 10, 3), np.uint8)
    grey[2:4, 3:7] = 3
    assert png.mask(png.encode(grey))[0].sum() == 8
    wide = np.zeros((10, 10), np.uint16)
    wide[2:4, 3:7] = 6
    wide[0, 0] = 256
    assert png.mask(png.encode(wide))[1] == [0, 6, 256]
    colour = np.zeros((4, 4, 3), np.uint8)
    colour[0, 0, 0] = 9
    for bad, reason in ((png.encode(colour), "colourised"), (png.encode(np.zeros((4, 4, 4), np.uint8)), "alpha"), (b"no png", "undecodable"), (png.encode(low)[:-20], "undecodable")):
        with pytest.raises(png.ImageError) as e:
            png.mask(bad)
        assert e.value.reason == reason


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.sampled_from([1, 3, 4]), st.integers(0, 4), st.randoms(use_true_random=False))
def test_png_filters(height, width, channels, kind, rng):
    import struct
    import zlib

    v = np.array([rng.randrange(256) for _ in range(height * width * channels)], np.uint8).reshape(height, width * channels)
    above = np.zeros(width * channels + channels, int)
    raw = b""
    for row in v:
        line = np.concatenate([np.zeros(channels, int), row.astype(int)])
        out = []
        for i in range(width * channels):
            a, b, c = line[i], above[i + channels], above[i]
            paeth = min(((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c)))[2]
            out.append((line[i + channels] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        raw += bytes([kind, *out])
        above = line
    part = lambda k, x: struct.pack(">I", len(x)) + k + x + struct.pack(">I", zlib.crc32(k + x))
    data = png.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")
    assert (png.decode(data)[0].reshape(height, -1) == v).all()
