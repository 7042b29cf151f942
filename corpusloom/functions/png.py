"""PNG images with 8 bits a channel, read and written with the standard library: enough to crop them."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed value
# Channels by colour type (grey, RGB, palette, grey and alpha, RGBA).
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _chunks(data: bytes) -> list[tuple[bytes, bytes]]:
    if not data.startswith(_SIGNATURE):
        raise ValueError("not a PNG image")
    out, at = [], len(_SIGNATURE)
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        out.append((kind, data[at + 8 : at + 8 + size]))
        at += size + 12
    return out


def _unfiltered(raw: np.ndarray, step: int) -> np.ndarray:
    """Rows of bytes from rows with their filter byte in front: each byte was stored as a difference to one to the left, above or both."""
    rows = np.zeros((len(raw), raw.shape[1] - 1), np.uint8)
    above = np.zeros(rows.shape[1], np.int64)
    for row, line in zip(rows, raw, strict=True):
        kind, value = line[0], line[1:].astype(np.int64)
        if kind == 1:
            value = value.reshape(-1, step).cumsum(axis=0).ravel()
        elif kind == 2:
            value = value + above
        elif kind in (3, 4):
            for i in range(len(value)):
                a, b, c = (int(value[i - step]) if i >= step else 0), int(above[i]), (int(above[i - step]) if i >= step else 0)
                nearest = (a + b) // 2 if kind == 3 else min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
                value[i] = (value[i] + nearest) & 255
        row[:] = above = value & 255
    return rows


def read(data: bytes) -> tuple[np.ndarray, dict[bytes, bytes]]:
    """Pixels (height x width x channels), and the header and palette chunks."""
    chunks = _chunks(data)
    kept = {k: v for k, v in chunks if k in (b"IHDR", b"PLTE", b"tRNS")}
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", kept[b"IHDR"])
    if depth != 8 or interlaced or colour not in _CHANNELS:
        raise ValueError("only PNG images with 8 bits a channel and without interlacing can be read")
    step = _CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(v for k, v in chunks if k == b"IDAT")), np.uint8).reshape(height, 1 + width * step)
    return _unfiltered(raw, step).reshape(height, width, step), kept


def write(pixels: np.ndarray, kept: dict[bytes, bytes]) -> bytes:
    """The image of these pixels with the colour type and palette of kept."""
    height, width, step = pixels.shape
    rows = np.zeros((height, 1 + width * step), np.uint8)
    rows[:, 1:] = pixels.reshape(height, -1)
    parts = [(b"IHDR", struct.pack(">II", width, height) + kept[b"IHDR"][8:]), *((k, v) for k, v in kept.items() if k != b"IHDR"), (b"IDAT", zlib.compress(rows.tobytes())), (b"IEND", b"")]
    return _SIGNATURE + b"".join(struct.pack(">I", len(v)) + k + v + struct.pack(">I", zlib.crc32(k + v)) for k, v in parts)


def cropped(data: bytes, box: tuple[int, int, int, int]) -> bytes:
    """The image within a box (left, top, right, bottom in pixels)."""
    pixels, kept = read(data)
    left, top, right, bottom = box
    if left >= right or top >= bottom:
        raise ValueError("the box holds no pixel")
    return write(pixels[top:bottom, left:right], kept)
