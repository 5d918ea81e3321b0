"""PNG bytes with the standard library only: 8-bit RGB, no filter, no interlace."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"  # fixed value of the format


def chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def header(height: int, width: int) -> bytes:
    """Signature and image header, up to the first data chunk."""
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))


def scanlines(rgb: np.ndarray) -> bytes:
    """Rows of an ``(h, w, 3)`` array, each led by filter type 0."""
    h, w, _ = rgb.shape
    lines = np.zeros((h, 1 + 3 * w), dtype=np.uint8)
    lines[:, 1:] = rgb.reshape(h, 3 * w)
    return lines.tobytes()


def deflate_band(raw: bytes) -> bytes:
    """Raw deflate of one band of scanlines, byte-aligned and without back-references to its
    neighbours, so that bands compressed apart can be concatenated."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    return packer.compress(raw) + packer.flush(zlib.Z_FULL_FLUSH)


def join_checksums(first: int, second: int, second_length: int) -> int:
    """Adler-32 of two byte strings put together, from the checksum of each."""
    base = 65521  # fixed value of Adler-32
    a1, b1 = first & 0xFFFF, first >> 16
    a2, b2 = second & 0xFFFF, second >> 16
    a = (a1 + a2 - 1) % base
    b = (b1 + b2 + second_length * (a1 - 1)) % base
    return (b << 16) | a


def trailer(bands) -> bytes:
    """The end of the data and of the image, from ``(checksum, raw_length)`` of the bands in row order."""
    checksum = 1
    for band_sum, raw_length in bands:
        checksum = join_checksums(checksum, band_sum, raw_length)
    return chunk(b"IDAT", b"\x03\x00" + struct.pack(">I", checksum)) + chunk(b"IEND", b"")


def encode(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    raw = scanlines(rgb)
    return (header(h, w) + chunk(b"IDAT", b"\x78\x9c") + chunk(b"IDAT", deflate_band(raw))
            + trailer([(zlib.adler32(raw), len(raw))]))


def decode(png: bytes) -> np.ndarray:
    """Pixels of an image written by this module; checks chunk and stream checksums."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, data, shape = 8, [], None
    while at < len(png):
        length = struct.unpack(">I", png[at:at + 4])[0]
        kind, body = png[at + 4:at + 8], png[at + 8:at + 8 + length]
        if struct.unpack(">I", png[at + 8 + length:at + 12 + length])[0] != zlib.crc32(kind + body):
            raise ValueError(f"bad checksum in chunk {kind!r}")
        if kind == b"IHDR":
            shape = struct.unpack(">II", body[:8])
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + length
    width, height = shape
    lines = np.frombuffer(zlib.decompress(b"".join(data)), dtype=np.uint8).reshape(height, 1 + 3 * width)
    if lines[:, 0].any():
        raise ValueError("only filter type 0 is supported")
    return lines[:, 1:].reshape(height, width, 3)
