"""PNG masks and images without an image library: raw palette indices or grey values are kept as they are."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class ImageError(ValueError):
    """A file that is not an acceptable image; the reason is a short code."""

    def __init__(self, reason: str, detail: str = ""):
        super().__init__(f"{reason}: {detail}" if detail else reason)
        self.reason = reason


def chunks(data: bytes):
    if data[:8] != SIGNATURE:
        raise ImageError("undecodable", "not a PNG")
    at = 8
    while at + 12 <= len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        if len(body) < n or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            raise ImageError("undecodable", "damaged chunk")
        yield kind, body
        at += 12 + n


def orientation(exif: bytes) -> int:
    """Tag 274 of a TIFF header block; 1 where it is absent."""
    if exif[:6] == b"Exif\0\0":
        exif = exif[6:]
    order = {b"II": "<", b"MM": ">"}.get(exif[:2])
    if order is None or len(exif) < 8:
        return 1
    (at,) = struct.unpack_from(order + "I", exif, 4)
    if at + 2 > len(exif):
        return 1
    (n,) = struct.unpack_from(order + "H", exif, at)
    for k in range(n):
        entry = exif[at + 2 + 12 * k : at + 14 + 12 * k]
        if len(entry) == 12 and struct.unpack_from(order + "H", entry)[0] == 274:
            return struct.unpack_from(order + "H", entry, 8)[0]
    return 1


def _unfilter(raw: np.ndarray, rows: int, size: int, step: int) -> np.ndarray:
    """Rows of size bytes after their filters are undone; step is the bytes of a pixel."""
    raw = raw.reshape(rows, size + 1)
    out = np.zeros((rows + 1, size + step), np.uint8)  # a row above and a pixel before of zeros
    for k in range(rows):
        kind, line, above = int(raw[k, 0]), raw[k, 1:], out[k]
        here = out[k + 1]
        if kind == 0:
            here[step:] = line
        elif kind == 2:
            here[step:] = line + above[step:]
        elif kind == 1:
            for c in range(step):
                here[step + c :: step] = np.cumsum(line[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind in (3, 4):
            for i, v in enumerate(line.tolist()):
                a, b, c = int(here[i]), int(above[i + step]), int(above[i])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    da, db, dc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if da <= db and da <= dc else b if db <= dc else c
                here[i + step] = (v + guess) & 255
        else:
            raise ImageError("undecodable", "unknown filter")
    return out[1:, step:]


def decode(data: bytes) -> tuple[np.ndarray, int]:
    """Samples (height, width, channels), palette indices not looked up, and the colour type."""
    head, body, exif = None, [], b""
    for kind, x in chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", x)
        elif kind == b"IDAT":
            body.append(x)
        elif kind == b"acTL":
            raise ImageError("multi_frame")
        elif kind == b"eXIf":
            exif = x
    if head is None or not body:
        raise ImageError("undecodable", "no image data")
    width, height, depth, colour, _, _, interlaced = head
    if orientation(exif) != 1:
        raise ImageError("exif")
    if interlaced or colour not in CHANNELS or depth not in (1, 2, 4, 8, 16):
        raise ImageError("undecodable", "interlaced or unknown PNG kind")
    n = CHANNELS[colour]
    size = (width * n * depth + 7) // 8
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
        rows = _unfilter(raw, height, size, max(1, n * depth // 8))
    except (zlib.error, ValueError) as e:
        raise ImageError("undecodable", str(e)) from e
    if depth == 16:
        values = rows.reshape(height, width * n, 2)
        values = values[:, :, 0].astype(np.uint16) * 256 + values[:, :, 1]
    elif depth == 8:
        values = rows
    else:
        bits = np.unpackbits(rows, axis=1).reshape(height, -1, depth)
        values = (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2).astype(np.uint8)[:, : width * n]
    return values.reshape(height, width, n), colour


def rgb(data: bytes) -> np.ndarray:
    """Pixels as 8-bit red, green and blue: palettes are looked up, alpha is dropped, of 16 bits the upper 8 are kept."""
    values, colour = decode(data)
    if values.dtype == np.uint16:
        values = (values >> 8).astype(np.uint8)
    if colour == 3:
        table = b"".join(x for kind, x in chunks(data) if kind == b"PLTE")
        table = np.frombuffer(table[: len(table) // 3 * 3], np.uint8).reshape(-1, 3)
        if values.size and int(values.max()) >= len(table):
            raise ImageError("undecodable", "palette index out of range")
        return table[values[:, :, 0]]
    return np.ascontiguousarray(values[:, :, :3]) if colour in (2, 6) else np.repeat(values[:, :, :1], 3, axis=2)


def mask(data: bytes) -> tuple[np.ndarray, list[int]]:
    """A 0/1 mask and its sorted raw values. Colour, and alpha that is not opaque, are errors."""
    values, colour = decode(data)
    if colour in (4, 6):
        opaque = 65535 if values.dtype == np.uint16 else 255
        if (values[:, :, -1] != opaque).any():
            raise ImageError("alpha")
        values = values[:, :, :-1]
    if values.shape[2] == 3 and not ((values[:, :, 0] == values[:, :, 1]) & (values[:, :, 1] == values[:, :, 2])).all():
        raise ImageError("colourised")
    plane = values[:, :, 0]
    return (plane > 0).astype(np.uint8), np.unique(plane).tolist()


def encode(values: np.ndarray, palette: bytes = b"") -> bytes:
    """A PNG of a (height, width[, channels]) array, grey, palette, RGB or with alpha by its channels."""
    v = values if values.ndim == 3 else values[:, :, None]
    colour = 3 if palette else {1: 0, 2: 4, 3: 2, 4: 6}[v.shape[2]]
    raw = v.astype(">u2").tobytes() if v.dtype == np.uint16 else v.astype(np.uint8).tobytes()
    size = len(raw) // v.shape[0]
    lines = b"".join(b"\0" + raw[k * size : (k + 1) * size] for k in range(v.shape[0]))
    part = lambda kind, x: struct.pack(">I", len(x)) + kind + x + struct.pack(">I", zlib.crc32(kind + x))
    head = struct.pack(">IIBBBBB", v.shape[1], v.shape[0], 16 if v.dtype == np.uint16 else 8, colour, 0, 0, 0)
    return SIGNATURE + part(b"IHDR", head) + (part(b"PLTE", palette) if palette else b"") + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")
