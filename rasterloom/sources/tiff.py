"""TIFF files without native libraries: directories, georeferencing, blocks.

Classic and BigTIFF of either byte order, directories anywhere in the file,
strips and tiles, bands together or apart, 8 to 64 bits a sample; uncompressed,
LZW, Deflate and PackBits with the horizontal and floating-point predictors.
Anything else is a ``ValueError`` that says what is not supported.
"""

from __future__ import annotations

import io
import struct
import zlib
from dataclasses import dataclass
from typing import BinaryIO
from xml.etree import ElementTree

import numpy as np

# Tag numbers, field types and codes of the TIFF 6.0, BigTIFF and GeoTIFF formats and of the common no-data and metadata tags.
SUBFILE, WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 254, 256, 257, 258, 259, 262, 270, 273, 277, 278, 279
PLANAR, SOFTWARE, DATETIME, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, EXTRA_SAMPLES, SAMPLE_FORMAT = 284, 305, 306, 317, 322, 323, 324, 325, 338, 339
PIXEL_SCALE, TIE_POINTS, TRANSFORM_TAG, GEO_KEYS, GEO_ASCII, METADATA, NODATA, RPC = 33550, 33922, 34264, 34735, 34737, 42112, 42113, 50844
SIZES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 7: ("B", 1), 8: ("h", 2), 9: ("i", 4), 10: ("ii", 8), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
RATIONALS = (5, 10)
KINDS = {1: "u", 2: "i", 3: "f"}
RASTER_TYPE_KEY, GEOGRAPHIC_KEY, PROJECTED_KEY, USER_DEFINED, POINT = 1025, 2048, 3072, 32767, 2
COMPRESSIONS = {1: "NONE", 5: "LZW", 7: "JPEG", 8: "DEFLATE", 32946: "DEFLATE", 32773: "PACKBITS", 50000: "ZSTD"}
#: Directories followed at most; a longer chain is an error.
MAX_DIRECTORIES = 256


@dataclass
class Tiff:
    """The directories of a file, without its pixels."""

    order: str
    big: bool
    directories: list[dict[int, tuple]]

    @property
    def tags(self) -> dict[int, tuple]:
        return self.directories[0]

    def one(self, tag: int, default=None):
        return self.tags.get(tag, (default,))[0]

    def text(self, tag: int) -> str:
        raw = self.tags.get(tag, (b"",))[0]
        return raw.split(b"\0")[0].decode("utf-8", "replace")

    @property
    def width(self) -> int:
        return self.tags[WIDTH][0]

    @property
    def height(self) -> int:
        return self.tags[HEIGHT][0]

    @property
    def count(self) -> int:
        return self.one(SAMPLES, 1)

    @property
    def apart(self) -> bool:
        return self.one(PLANAR, 1) == 2

    @property
    def block(self) -> tuple[int, int]:
        """(width, height) of a tile or strip."""
        if TILE_WIDTH in self.tags:
            return self.tags[TILE_WIDTH][0], self.tags[TILE_HEIGHT][0]
        return self.width, min(self.height, self.one(ROWS_PER_STRIP, self.height))

    def dtype(self) -> np.dtype:
        bits, formats = set(self.tags.get(BITS, (1,))), set(self.tags.get(SAMPLE_FORMAT, (1,)))
        if len(bits) > 1 or len(formats) > 1:
            raise ValueError("bands of different types are not supported")
        (size,), (kind,) = bits, formats
        if size not in (8, 16, 32, 64) or kind not in KINDS or (kind == 3 and size == 8):
            raise ValueError(f"{size} bits of sample format {kind} are not supported")
        return np.dtype(f"{KINDS[kind]}{size // 8}")

    def compression(self) -> str:
        return COMPRESSIONS.get(self.one(COMPRESSION, 1), str(self.one(COMPRESSION, 1)))

    def nodata(self) -> float | None:
        text = self.text(NODATA).strip()
        return float(text) if text else None

    def geo_keys(self) -> dict[int, int]:
        keys = self.tags.get(GEO_KEYS, ())
        return {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}

    def srid(self) -> int | None:
        keys = self.geo_keys()
        for key in (PROJECTED_KEY, GEOGRAPHIC_KEY):
            if keys.get(key, USER_DEFINED) != USER_DEFINED:
                return keys[key]
        return None

    def transform(self) -> list[float] | None:
        """(x0, dx, rx, y0, ry, dy) of the upper left corner, from a matrix or from scale and tie point."""
        scale, ties, matrix = self.tags.get(PIXEL_SCALE), self.tags.get(TIE_POINTS), self.tags.get(TRANSFORM_TAG)
        if matrix:
            found = [matrix[3], matrix[0], matrix[1], matrix[7], matrix[4], matrix[5]]
        elif scale and ties and len(ties) == 6:
            col, row, _, x, y, _ = ties
            found = [x - col * scale[0], scale[0], 0.0, y + row * scale[1], 0.0, -scale[1]]
        else:
            return None
        if self.geo_keys().get(RASTER_TYPE_KEY) == POINT:  # given for the pixel's centre
            found[0] -= (found[1] + found[2]) / 2
            found[3] -= (found[4] + found[5]) / 2
        return [float(v) for v in found]

    def control_points(self) -> list[dict]:
        ties = self.tags.get(TIE_POINTS, ())
        if len(ties) <= 6 and PIXEL_SCALE in self.tags or TRANSFORM_TAG in self.tags:
            return []
        return [{"id": str(n + 1), "pixel": ties[k], "line": ties[k + 1], "x": ties[k + 3], "y": ties[k + 4], "z": ties[k + 5]} for n, k in enumerate(range(0, len(ties) - 5, 6))]

    def overviews(self) -> int:
        return sum(1 for d in self.directories[1:] if d.get(SUBFILE, (0,))[0] & 5 == 1)

    def masked(self) -> bool:
        return any(d.get(SUBFILE, (0,))[0] & 4 for d in self.directories[1:])

    def items(self) -> list[dict[str, str]]:
        """The entries of the metadata tag: name, value and, where given, sample, role and domain."""
        text = self.text(METADATA)
        if not text:
            return []
        try:
            return [{**i.attrib, "value": i.text or ""} for i in ElementTree.fromstring(text).iter("Item")]
        except ElementTree.ParseError:
            return []

    def colors(self) -> list[str]:
        """What each band shows."""
        photometric, extra = self.one(PHOTOMETRIC, 1), self.tags.get(EXTRA_SAMPLES, ())
        first = {2: ["Red", "Green", "Blue"], 3: ["Palette"]}.get(photometric, ["Gray"])
        rest = ["Alpha" if e in (1, 2) else "Undefined" for e in extra]
        return (first + rest + ["Undefined"] * self.count)[: self.count]


def _take(src: BinaryIO, at: int, n: int) -> bytes:
    src.seek(at)
    raw = src.read(n)
    if len(raw) != n:
        raise ValueError("the file is cut short")
    return raw


def parse(src: BinaryIO) -> Tiff:
    """All directories of an open file that can seek; only they are read."""
    head = _take(src, 0, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    magic = struct.unpack(f"{order}H", head[2:4])[0] if order else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    (at,) = struct.unpack(order + "Q", _take(src, 8, 8)) if big else struct.unpack(order + "I", head[4:])
    count_code, entry_code, offset_code, inline = ("Q", "HHQ", "Q", 8) if big else ("H", "HHI", "I", 4)
    count_size, entry_size = struct.calcsize(count_code), struct.calcsize("<" + entry_code) + inline
    directories, seen = [], set()
    while at:
        if at in seen or len(seen) == MAX_DIRECTORIES:
            raise ValueError("the chain of directories does not end")
        seen.add(at)
        (n,) = struct.unpack(order + count_code, _take(src, at, count_size))
        raw = _take(src, at + count_size, n * entry_size + inline)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + entry_code, raw, k * entry_size)
            if kind not in SIZES:
                continue
            code, size = SIZES[kind]
            where = k * entry_size + entry_size - inline
            if size * count <= inline:
                held = raw[where : where + size * count]
            else:
                held = _take(src, struct.unpack_from(order + offset_code, raw, where)[0], size * count)
            if kind == 2:
                tags[tag] = (held,)
                continue
            values = struct.unpack(order + code * count, held)
            tags[tag] = tuple(a / b if b else 0.0 for a, b in zip(values[::2], values[1::2], strict=True)) if kind in RATIONALS else values
        (at,) = struct.unpack_from(order + offset_code, raw, n * entry_size)
        directories.append(tags)
    if not directories or WIDTH not in directories[0] or HEIGHT not in directories[0]:
        raise ValueError("the file has no image")
    return Tiff(order, big, directories)


def unpack_bits(raw: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out += raw[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += raw[at + 1 : at + 2] * (257 - n)
            at += 1 if n == 128 else 2
    return bytes(out)


def unpack_lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant first; the width grows one code early."""
    clear, end = 256, 257
    base = [bytes([b]) for b in range(256)] + [b"", b""]
    table, width, last = list(base), 9, None
    out, held, bits = [], 0, 0
    for byte in raw:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == clear:
            table, width, last = list(base), 9, None
            continue
        if code == end:
            break
        if last is None:
            word = table[code]
        elif code < len(table):
            word = table[code]
            table.append(last + word[:1])
        elif code == len(table):
            word = last + last[:1]
            table.append(word)
        else:
            raise ValueError("damaged LZW data")
        out.append(word)
        last = word
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def _decoded(tiff: Tiff, raw: bytes) -> bytes:
    kind = tiff.compression()
    if kind == "NONE":
        return raw
    if kind == "DEFLATE":
        return zlib.decompress(raw)
    if kind == "LZW":
        return unpack_lzw(raw)
    if kind == "PACKBITS":
        return unpack_bits(raw)
    raise ValueError(f"compression {kind} is not supported")


def _block_array(tiff: Tiff, raw: bytes, rows: int, cols: int, samples: int) -> np.ndarray:
    """[row, column, sample] of a decoded block."""
    kind, predictor = tiff.dtype(), tiff.one(PREDICTOR, 1)
    size = rows * cols * samples * kind.itemsize
    if len(raw) < size:
        raise ValueError("a block is cut short")
    if predictor == 3:
        parts = np.frombuffer(raw[:size], np.uint8).reshape(rows, -1, samples)
        parts = np.cumsum(parts, axis=1, dtype=np.uint8).reshape(rows, kind.itemsize, cols * samples)
        values = np.ascontiguousarray(parts.transpose(0, 2, 1)).view(kind.newbyteorder(">"))
        return values.reshape(rows, cols, samples).astype(kind)
    array = np.frombuffer(raw[:size], kind.newbyteorder(tiff.order)).reshape(rows, cols, samples).astype(kind)
    if predictor == 2:
        return np.cumsum(array, axis=1, dtype=kind)
    if predictor != 1:
        raise ValueError(f"predictor {predictor} is not supported")
    return array


def read_window(src: BinaryIO, tiff: Tiff, x: int, y: int, w: int, h: int, bands: list[int] | None = None) -> np.ndarray:
    """(bands, h, w) of the window. Only blocks under it are read, of uncompressed ones only the rows under it."""
    bands = bands or list(range(1, tiff.count + 1))
    if x < 0 or y < 0 or w <= 0 or h <= 0 or x + w > tiff.width or y + h > tiff.height:
        raise ValueError("window outside the raster")
    if any(b < 1 or b > tiff.count for b in bands):
        raise ValueError("no such band")
    tiled = TILE_WIDTH in tiff.tags
    offsets, sizes = tiff.tags[TILE_OFFSETS if tiled else STRIP_OFFSETS], tiff.tags.get(TILE_COUNTS if tiled else STRIP_COUNTS)
    (bw, bh), kind = tiff.block, tiff.dtype()
    across, down = -(-tiff.width // bw), -(-tiff.height // bh)
    samples = 1 if tiff.apart else tiff.count
    out = np.empty((len(bands), h, w), kind)
    for by in range(y // bh, (y + h - 1) // bh + 1):
        rows = bh if tiled else min(bh, tiff.height - by * bh)
        top, low = max(y, by * bh), min(y + h, by * bh + rows)
        for bx in range(x // bw, (x + w - 1) // bw + 1):
            left, right = max(x, bx * bw), min(x + w, bx * bw + bw)
            for plane in sorted(set(bands)) if tiff.apart else [0]:
                number = by * across + bx + (max(0, plane - 1)) * across * down
                if offsets[number] == 0 and sizes and sizes[number] == 0:  # a block that was never written
                    part = np.full((low - top, bw, samples), tiff.nodata() or 0, kind)
                elif tiff.compression() == "NONE" and tiff.one(PREDICTOR, 1) == 1:
                    line = bw * samples * kind.itemsize
                    raw = _take(src, offsets[number] + (top - by * bh) * line, (low - top) * line)
                    part = _block_array(tiff, raw, low - top, bw, samples)
                else:
                    if not sizes:
                        raise ValueError("sizes of compressed blocks are missing")
                    part = _block_array(tiff, _decoded(tiff, _take(src, offsets[number], sizes[number])), rows, bw, samples)[top - by * bh : low - by * bh]
                part = part[:, left - bx * bw : right - bx * bw]
                for n, band in enumerate(bands):
                    if not tiff.apart or band == plane:
                        out[n, top - y : low - y, left - x : right - x] = part[:, :, 0 if tiff.apart else band - 1]
    return out


@dataclass(frozen=True)
class Layout:
    """How a file is laid out: tiles of ``tile`` pixels or one strip a band, bands together or apart."""

    tile: int | None = None
    together: bool = False
    compress: str = "NONE"
    predictor: int = 1
    big: bool = False
    at_end: bool = False  # the directory after the pixels, as streams leave it


def encode(array: np.ndarray, transform: list[float] | None, srid: int | None, nodata: float | None = None, layout: Layout = Layout(), items: dict[str, str] | None = None, descriptions: list[str] | None = None) -> bytes:
    """A file with the bands of ``array`` (bands, height, width), metadata items and band descriptions."""
    array = np.ascontiguousarray(array)
    bands, height, width = array.shape
    kind = {"u": 1, "i": 2, "f": 3}[array.dtype.kind]
    if layout.predictor == 2 and kind == 3 or layout.predictor not in (1, 2) or layout.compress not in ("NONE", "DEFLATE"):
        raise ValueError("this layout is not written")
    bw, bh = (layout.tile, layout.tile) if layout.tile else (width, height)
    planes = [array.transpose(1, 2, 0)] if layout.together else [b[:, :, None] for b in array]
    blocks = []
    for plane in planes:
        for top in range(0, height, bh):
            for left in range(0, width, bw):
                part = plane[top : top + bh, left : left + bw]
                if layout.tile:
                    part = np.pad(part, ((0, bh - part.shape[0]), (0, bw - part.shape[1]), (0, 0)), mode="edge")
                if layout.predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
                raw = np.ascontiguousarray(part.astype(array.dtype.newbyteorder("<"))).tobytes()
                blocks.append(zlib.compress(raw, 6) if layout.compress == "DEFLATE" else raw)
    word = 16 if layout.big else 4
    tags: list[tuple[int, int, list]] = [
        (WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [array.dtype.itemsize * 8] * bands), (COMPRESSION, 3, [8 if layout.compress == "DEFLATE" else 1]), (PHOTOMETRIC, 3, [1]),
        (SAMPLES, 3, [bands]), (PLANAR, 3, [1 if layout.together else 2]), (SAMPLE_FORMAT, 3, [kind] * bands),
    ]
    if layout.tile:
        tags += [(TILE_WIDTH, 4, [bw]), (TILE_HEIGHT, 4, [bh]), (TILE_OFFSETS, word, [0] * len(blocks)), (TILE_COUNTS, word, [len(b) for b in blocks])]
    else:
        tags += [(ROWS_PER_STRIP, 4, [height]), (STRIP_OFFSETS, word, [0] * len(blocks)), (STRIP_COUNTS, word, [len(b) for b in blocks])]
    if layout.predictor != 1:
        tags.append((PREDICTOR, 3, [layout.predictor]))
    if bands > 1:
        tags.append((EXTRA_SAMPLES, 3, [0] * (bands - 1)))
    if transform:
        x0, dx, rx, y0, ry, dy = transform
        if rx == 0 and ry == 0 and dx > 0 and dy < 0:
            tags += [(PIXEL_SCALE, 12, [dx, -dy, 0.0]), (TIE_POINTS, 12, [0.0, 0.0, 0.0, x0, y0, 0.0])]
        else:
            tags.append((TRANSFORM_TAG, 12, [dx, rx, 0.0, x0, ry, dy, 0.0, y0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]))
    if srid:
        geographic = 4000 <= srid < 5000
        tags.append((GEO_KEYS, 3, [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, RASTER_TYPE_KEY, 0, 1, 1, GEOGRAPHIC_KEY if geographic else PROJECTED_KEY, 0, 1, srid]))
    root = ElementTree.Element("GDALMetadata")
    for name, value in (items or {}).items():
        ElementTree.SubElement(root, "Item", name=name).text = value
    for n, value in enumerate(descriptions or ()):
        ElementTree.SubElement(root, "Item", name="DESCRIPTION", sample=str(n), role="description").text = value
    if len(root):
        tags.append((METADATA, 2, [ElementTree.tostring(root) + b"\0"]))
    if nodata is not None:
        tags.append((NODATA, 2, [f"{nodata:.17g}".encode() + b"\0"]))
    return _assemble(sorted(tags), blocks, layout)


def strip_head(shape: tuple[int, int, int], kind: np.dtype, strip_rows: int, transform: list[float] | None, srid: int | None) -> bytes:
    """What stands before the pixels of an uncompressed file whose strips follow in order, each with all bands one after the other."""
    bands, height, width = shape
    starts = range(0, height, strip_rows)
    line = width * kind.itemsize
    sizes = [min(strip_rows, height - top) * line for top in starts for _ in range(bands)]
    layout = Layout(big=sum(sizes) >= (1 << 32) - (1 << 20))
    whole = encode(np.zeros((bands, 1, 1), kind), transform, srid)  # its tags, with the sizes of this file
    found = parse(io.BytesIO(whole)).tags
    word = 16 if layout.big else 4
    tags = [(t, k, list(v)) for t, k, v in ((t, _kind_of(t), v) for t, v in found.items()) if t not in (WIDTH, HEIGHT, ROWS_PER_STRIP, STRIP_OFFSETS, STRIP_COUNTS)]
    tags += [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (ROWS_PER_STRIP, 4, [strip_rows])]
    # In the file: strip by strip, in each band by band; in the directory: band by band.
    by_band = [sizes[s * bands + b] for b in range(bands) for s in range(len(starts))]
    head = _assemble(sorted([*tags, (STRIP_OFFSETS, word, [0] * len(sizes)), (STRIP_COUNTS, word, by_band)]), [], layout, sizes)
    places = len(head) + np.concatenate([[0], np.cumsum(sizes)])[:-1]
    offsets = [int(places[s * bands + b]) for b in range(bands) for s in range(len(starts))]
    return _assemble(sorted([*tags, (STRIP_OFFSETS, word, offsets), (STRIP_COUNTS, word, by_band)]), [], layout, sizes)


def _kind_of(tag: int) -> int:
    return 12 if tag in (PIXEL_SCALE, TIE_POINTS, TRANSFORM_TAG) else 2 if tag in (METADATA, NODATA) else 3


def _assemble(tags: list[tuple[int, int, list]], blocks: list[bytes], layout: Layout, placed: list[int] | None = None) -> bytes:
    """Head, directory and blocks; with ``placed`` the offsets are those given and the blocks follow elsewhere."""
    entry, offset, inline, first = ("<HHQ", "<Q", 8, 16) if layout.big else ("<HHI", "<I", 4, 8)
    count = "<Q" if layout.big else "<H"
    sizes = np.array([0] + [len(b) for b in blocks], np.int64)

    def directory(at: int, data_at: int) -> bytes:
        """The directory and its longer values, written at ``at``."""
        spare = at + struct.calcsize(count) + len(tags) * (struct.calcsize(entry) + inline) + inline
        head, tail = struct.pack(count, len(tags)), b""
        for tag, kind, values in tags:
            if tag in (TILE_OFFSETS, STRIP_OFFSETS) and placed is None:
                values = (data_at + np.cumsum(sizes)[:-1]).tolist()
            raw = values[0] if kind == 2 else struct.pack("<" + SIZES[kind][0] * len(values), *values)
            head += struct.pack(entry, tag, kind, len(raw) if kind == 2 else len(values))
            if len(raw) <= inline:
                head += raw.ljust(inline, b"\0")
            else:
                head += struct.pack(offset, spare + len(tail))
                tail += raw + b"\0" * (len(raw) % 2)
        return head + struct.pack(offset, 0) + tail

    body = b"".join(blocks)
    at = first + len(body) + len(body) % 2 if layout.at_end else first
    if not layout.big and at + len(body) >= 1 << 32:
        raise ValueError("a classic file ends at 4 GB")
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if layout.big else struct.pack("<2sHI", b"II", 42, at)
    if layout.at_end:
        return head + body + b"\0" * (len(body) % 2) + directory(at, first)
    size = len(directory(at, 0))
    return head + directory(at, at + size) + body
