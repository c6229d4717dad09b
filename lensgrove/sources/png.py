"""PNG files in numpy: 8-bit grey, RGB and RGBA, not interlaced; enough for masks, overlays and cut-outs."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_HEAD = b"\x89PNG\r\n\x1a\n"


def encode(pixels: np.ndarray) -> bytes:
    """(h, w), (h, w, 3) or (h, w, 4) uint8 as PNG."""
    a = np.ascontiguousarray(pixels, np.uint8)
    kind = {1: 0, 3: 2, 4: 6}[1 if a.ndim == 2 else a.shape[2]]
    h, w = a.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, -1)], 1).tobytes()

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    return _HEAD + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """PNG as (h, w, channels) uint8; ValueError for anything else."""
    if data[:8] != _HEAD:
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at + 8 <= len(data):
        size, tag = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if tag == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif tag == b"IDAT":
            body += part
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("unsupported PNG")
    w, h, c = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h, w * c), np.uint8)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        up = out[y - 1].astype(np.int32) if y else np.zeros(w * c, np.int32)
        if kind == 0:
            out[y] = line
        elif kind == 2:
            out[y] = line + up & 255
        else:
            row = np.zeros(w * c + c, np.int32)
            above = np.r_[np.zeros(c, np.int32), up]
            for x in range(w * c):
                left, over, corner = row[x], above[x + c], above[x]
                if kind == 1:
                    guess = left
                elif kind == 3:
                    guess = left + over >> 1
                else:
                    p = left + over - corner
                    guess = min((abs(p - left), 0, left), (abs(p - over), 1, over), (abs(p - corner), 2, corner))[2]
                row[x + c] = line[x] + guess & 255
            out[y] = row[c:]
    return out.reshape(h, w, c)


def to_rgb(pixels: np.ndarray) -> np.ndarray:
    """Any decoded image as (h, w, 3)."""
    return np.repeat(pixels, 3, 2) if pixels.shape[2] == 1 else pixels[:, :, :3]
