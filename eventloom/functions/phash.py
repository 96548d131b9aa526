"""Perceptual hashes of images: luminance, a small square, its lowest frequencies, and which of them exceed their median."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


class Unreadable(ValueError):
    """The bytes are no image of a kind that is read here."""


def _pnm(data: bytes) -> np.ndarray:
    """Binary PGM or PPM of 8 bits."""
    numbers, at = [], 2
    while len(numbers) < 3:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        numbers.append(int(data[at:end]))
        at = end
    width, height, most = numbers
    depth = 3 if data[:2] == b"P6" else 1
    if most != 255:
        raise Unreadable(f"{most} levels")
    return np.frombuffer(data, np.uint8, width * height * depth, at + 1).reshape(height, width, depth)


def _bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 24 bits."""
    start, = struct.unpack_from("<I", data, 10)
    width, height, _, bits, packed = struct.unpack_from("<iiHHI", data, 18)
    if bits != 24 or packed:
        raise Unreadable(f"{bits} bits, compression {packed}")
    stride = (3 * width + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)[:, : 3 * width].reshape(abs(height), width, 3)[:, :, ::-1]
    return rows[::-1] if height > 0 else rows


def _png(data: bytes) -> np.ndarray:
    """PNG of 8 bits a channel, not interlaced, grey or colour, with or without alpha, which is left out."""
    at, body, head = 8, b"", None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body += part
        at += 12 + size
    if head is None or head[2] != 8 or head[6] or head[3] not in (0, 2, 4, 6):
        raise Unreadable("kind of PNG")
    width, height, depth = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * depth)
    out = np.zeros((height, width, depth), np.uint8)
    above = np.zeros((width, depth), np.uint8)
    for y in range(height):
        way, line = int(raw[y, 0]), raw[y, 1:].reshape(width, depth)
        if way == 0:
            above = line
        elif way == 1:
            above = np.cumsum(line, axis=0, dtype=np.uint8)
        elif way == 2:
            above = line + above
        elif way in (3, 4):
            row, left, corner = np.empty((width, depth), np.int32), np.zeros(depth, np.int32), np.zeros(depth, np.int32)
            for x in range(width):
                up = above[x].astype(np.int32)
                if way == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (line[x] + guess) & 255, up
                row[x] = left
            above = row.astype(np.uint8)
        else:
            raise Unreadable(f"filter {way}")
        out[y] = above
    return out[:, :, : 1 if depth < 3 else 3]


def decode(data: bytes) -> np.ndarray:
    """Luminance (height x width, 0 to 255) of an image; Unreadable if it is of another kind or broken."""
    try:
        if data[:2] in (b"P5", b"P6"):
            x = _pnm(data)
        elif data[:2] == b"BM":
            x = _bmp(data)
        elif data[:8] == b"\x89PNG\r\n\x1a\n":
            x = _png(data)
        else:
            raise Unreadable("kind of image")
    except (ValueError, IndexError, struct.error, zlib.error) as e:
        raise Unreadable(str(e)) from e
    if not x.size:
        raise Unreadable("no pixels")
    if x.shape[2] == 1:
        return x[:, :, 0]
    return ((x.astype(np.int64) @ np.array([19595, 38470, 7471]) + 0x8000) >> 16).astype(np.uint8)


@lru_cache(maxsize=64)
def _weights(size: int, to: int) -> np.ndarray:
    """Lanczos weights of three lobes that bring `size` samples to `to`."""
    scale = size / to
    wide = max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    return w / w.sum(axis=1, keepdims=True)


def square(lum: np.ndarray, side: int = 32) -> np.ndarray:
    """Luminance brought to side x side, first across, then down, rounded to whole levels after each."""
    level = lambda a: np.clip(np.floor(a + 0.5), 0, 255)
    across = level(lum.astype(np.float64) @ _weights(lum.shape[1], side).T)
    return level(_weights(lum.shape[0], side) @ across)


def low_frequencies(x: np.ndarray, size: int) -> np.ndarray:
    """The size x size lowest frequencies of the cosine transform (type II) of each of a batch of squares, as two matrix products."""
    side = x.shape[-1]
    basis = 2 * np.cos(np.pi * np.arange(size)[:, None] * (2 * np.arange(side)[None, :] + 1) / (2 * side))
    return basis @ x @ basis.T


def bits_over_median(low: np.ndarray) -> list[str]:
    """For each of a batch of squares, which values exceed the square's median, row by row, as hexadecimal digits."""
    flat = low.reshape(len(low), -1)
    over = flat > np.median(flat, axis=1, keepdims=True)
    width = -(-flat.shape[1] // 4)
    return [f"{int(''.join('1' if b else '0' for b in row), 2):0{width}x}" for row in over]


def hash_squares(df: DataFrame, column: str, *, side: int = 32, size: int = 8, out: str = "phash") -> DataFrame:
    """df with the hash of a column of side * side luminances, row by row; null where it is null, of another length, or holds null or NaN."""
    keep = [c for c in df.columns if c != out]
    schema = df.select(*keep).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b[column].to_pylist()
            good = [n for n, r in enumerate(rows) if r is not None and len(r) == side * side and None not in r and np.isfinite(r).all()]
            found: list[str | None] = [None] * len(rows)
            if good:
                x = np.array([rows[n] for n in good], np.float64).reshape(-1, side, side)
                for n, h in zip(good, bits_over_median(low_frequencies(x, size))):
                    found[n] = h
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], pa.array(found, pa.string())], [*keep, out])

    return df.select(*keep).mapInArrow(run, schema)


def hash_images(df: DataFrame, *, path: str = "path", content: str = "content") -> DataFrame:
    """(path, phash, problem) of images: 64 bits as 16 hexadecimal digits, or null and why. Contents stay in their tasks.

    Read are PNG, BMP and binary PNM; other kinds (JPEG, WebP) need a decoder that is not at hand and have a problem.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, problems = [], []
            for data in b[content].to_pylist():
                try:
                    hashes += bits_over_median(low_frequencies(square(decode(data or b""))[None], 8))
                    problems.append(None)
                except Unreadable as e:
                    hashes.append(None)
                    problems.append(f"unreadable: {e}")
            yield pa.RecordBatch.from_arrays([b[path], pa.array(hashes, pa.string()), pa.array(problems, pa.string())], ["path", "phash", "problem"])

    return df.select(path, content).mapInArrow(run, "path string, phash string, problem string")
