"""TIFF media columns: one row for each page of each image.

The reader walks the chain of image directories in either byte order, takes strips or tiles, decodes PackBits, LZW or
deflate, undoes the horizontal predictor, and gives the samples of each page as interleaved bytes. The writer makes files for
the round trip, with the same codings.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import blocks, text_of

# Fixed values of the TIFF format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
FILL_ORDER = 266
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
CODINGS = {"none": NONE, "lzw": LZW, "deflate": DEFLATE, "packbits": PACKBITS}
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 7: "B", 8: "h", 9: "i"}

PAGE = "page_no int, width int, height int, samples int, bits int, coding int, pixels binary, error string"


@dataclass
class Page:
    width: int
    height: int
    samples: int
    bits: int
    coding: int
    pixels: bytes


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += data[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as runs, the rest as literals."""
    if not data:
        return b""
    raw = np.frombuffer(data, np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(raw)) + 1, [len(raw)]])
    out, literal = bytearray(), bytearray()

    def flush() -> None:
        for k in range(0, len(literal), 128):
            part = literal[k : k + 128]
            out.append(len(part) - 1)
            out.extend(part)
        literal.clear()

    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if hi - lo < 3:
            literal += data[lo:hi]
            continue
        flush()
        for k in range(lo, hi, 128):
            n = min(128, hi - k)
            out += bytes([257 - n if n > 1 else 0, data[lo]])
    flush()
    return bytes(out)


class _Bits:
    """Codes of growing width, most significant bit first."""

    def __init__(self) -> None:
        self.out, self.held, self.n = bytearray(), 0, 0

    def put(self, code: int, width: int) -> None:
        self.held, self.n = self.held << width | code, self.n + width
        while self.n >= 8:
            self.n -= 8
            self.out.append(self.held >> self.n & 255)
        self.held &= (1 << self.n) - 1

    def end(self) -> bytes:
        if self.n:
            self.out.append(self.held << (8 - self.n) & 255)
        return bytes(self.out)


def pack_lzw(data: bytes) -> bytes:
    bits, width, known = _Bits(), 9, {}
    bits.put(256, 9)
    following, word = 258, -1
    for b in data:
        if word < 0:
            word = b
            continue
        if (longer := known.get(word << 8 | b)) is not None:
            word = longer
            continue
        bits.put(word, width)
        known[word << 8 | b] = following
        following += 1
        # codes widen one early in this format
        if following == 4095:
            bits.put(256, width)
            known, following, width = {}, 258, 9
        elif following >= (1 << width):
            width += 1
        word = b
    if word >= 0:
        bits.put(word, width)
        following += 1
        if following >= (1 << width) and width < 12:
            width += 1
    bits.put(257, width)
    return bits.end()


def unpack_lzw(data: bytes, size: int) -> bytes:
    table: list[bytes] = []
    out, held, n, width, before = [], 0, 0, 9, b""
    made = 0
    for byte in data:
        held, n = held << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code = held >> n
        held &= (1 << n) - 1
        if code == 256:
            table, width, before = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code == 257 or made >= size:
            break
        if not before:
            word = table[code]
        else:
            word = table[code] if code < len(table) else before + before[:1]
            table.append(before + word[:1])
            width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
        out.append(word)
        made += len(word)
        before = word
    return b"".join(out)


def _unpack(coding: int, data: bytes, size: int) -> bytes:
    if coding == NONE:
        return data
    if coding == PACKBITS:
        return unpack_bits(data, size)
    if coding == LZW:
        return unpack_lzw(data, size)
    if coding in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    raise ValueError(f"compression {coding} isn't supported")


def _pack(coding: int, data: bytes) -> bytes:
    return {NONE: bytes, PACKBITS: pack_bits, LZW: pack_lzw, DEFLATE: lambda x: zlib.compress(x, 6)}[coding](data)


def walk(data: bytes) -> Iterator[Page | ValueError]:
    """The pages of one file, in the order of its directories, or what is wrong with a page; the chain of directories goes on
    after a page that can't be read. Without a chain it raises ValueError."""
    order = {b"II": "<", b"MM": ">"}.get(bytes(data[:2]))
    if order is None or len(data) < 8 or struct.unpack(f"{order}H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack(f"{order}I", data[4:8])[0], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("the chain of directories is damaged")
        seen.add(at)
        count = struct.unpack_from(f"{order}H", data, at)[0]
        if at + 2 + 12 * count + 4 > len(data):
            raise ValueError("a directory is cut off")
        try:
            yield _page(data, _tags(data, at, count, order), order)
        except (ValueError, zlib.error, IndexError, struct.error) as e:
            yield ValueError(str(e))
        at = struct.unpack_from(f"{order}I", data, at + 2 + 12 * count)[0]


def read_pages(data: bytes) -> Iterator[Page]:
    """The pages of one file; a damaged one, or one that isn't supported, raises ValueError."""
    for page in walk(data):
        if isinstance(page, ValueError):
            raise page
        yield page


def _tags(data: bytes, at: int, count: int, order: str) -> dict:
    tags = {}
    for k in range(count):
        tag, kind, n = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        if kind in TYPES:
            size, place = struct.calcsize(TYPES[kind]) * n, at + 10 + 12 * k
            if size > 4:
                place = struct.unpack_from(f"{order}I", data, place)[0]
            if place + size > len(data):
                raise ValueError("a directory's values are cut off")
            tags[tag] = struct.unpack_from(f"{order}{n}{TYPES[kind]}", data, place)
    return tags


def _page(data: bytes, tags: dict, order: str) -> Page:
    """Pixels of 8 bits a sample, 1-bit samples as 0 and 255, or of 16 bits, the lower byte first; interleaved."""
    if WIDTH not in tags or HEIGHT not in tags:
        raise ValueError("a page has no size")
    w, h, s = tags[WIDTH][0], tags[HEIGHT][0], tags.get(SAMPLES, (1,))[0]
    coding, predictor = tags.get(COMPRESSION, (NONE,))[0], tags.get(PREDICTOR, (1,))[0]
    bits, planes = set(tags.get(BITS, (1,))), s if tags.get(PLANAR, (1,))[0] == 2 else 1
    if len(bits) != 1 or not bits <= {1, 8, 16}:
        raise ValueError("only samples of 1, 8 or 16 bits are supported")
    (b,) = bits
    if tags.get(PLANAR, (1,))[0] not in (1, 2) or predictor not in (1, 2) or (predictor == 2 and b == 1) or tags.get(FILL_ORDER, (1,))[0] != 1:
        raise ValueError("a planar layout, predictor or order of bits that isn't supported")
    tiled = TILE_WIDTH in tags
    tw, th = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (w, min(h, tags.get(ROWS_PER_STRIP, (h,))[0]))
    offsets, counts = (tags.get(TILE_OFFSETS), tags.get(TILE_COUNTS)) if tiled else (tags.get(STRIP_OFFSETS), tags.get(STRIP_COUNTS))
    if not (tw and th and offsets and counts and len(offsets) == len(counts)):
        raise ValueError("a page's strips or tiles are missing")
    across, down, depth = -(-w // tw), -(-h // th), s // planes
    if len(offsets) < across * down * planes:
        raise ValueError("a page's strips or tiles are missing")
    out, wide = np.zeros((h, w, s), "<u2" if b == 16 else np.uint8), -(-tw * depth * b // 8)
    for k in range(across * down * planes):
        plane, j = divmod(k, across * down)
        y, x = j // across * th, j % across * tw
        rows = th if tiled else min(th, h - y)
        size = rows * wide
        if offsets[k] + counts[k] > len(data):
            raise ValueError("a strip or tile is cut off")
        raw = _unpack(coding, data[offsets[k] : offsets[k] + counts[k]], size)
        if len(raw) < size:
            raise ValueError("a strip or tile is too short")
        part = np.frombuffer(raw, np.uint8, size).reshape(rows, wide)
        if b == 1:
            part = np.unpackbits(part, axis=1)[:, : tw * depth] * np.uint8(255)
        elif b == 16:
            part = np.ascontiguousarray(part).view(f"{order}u2").astype("<u2")
        part = part.reshape(rows, tw, depth)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=part.dtype)
        out[y : y + rows, x : x + tw, plane * depth : (plane + 1) * depth] = part[: h - y, : w - x]
    return Page(w, h, s, b, coding, out.tobytes())


def write_pages(pages: list[np.ndarray], coding: str = "deflate", predictor: bool = True, rows_per_strip: int = 64, tile: int | None = None, order: str = "<") -> bytes:
    """A file of pages (height, width, samples), uint8, none empty. tile: side of its tiles, a multiple of 16."""
    out = bytearray({"<": b"II", ">": b"MM"}[order] + struct.pack(f"{order}HI", 42, 0))
    link = 4
    for page in pages:
        h, w, s = page.shape
        tw, th = (tile, tile) if tile else (w, rows_per_strip)
        offsets, counts = [], []
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = page[y : y + th, x : x + tw]
                if tile and part.shape[:2] != (th, tw):
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)))
                if predictor:
                    part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
                offsets.append(len(out))
                out += (packed := _pack(CODINGS[coding], part.tobytes()))
                counts.append(len(packed))
                out += b"\0" * (len(out) % 2)
        tags = {WIDTH: ("I", [w]), HEIGHT: ("I", [h]), BITS: ("H", [8] * s), COMPRESSION: ("H", [CODINGS[coding]]), PHOTOMETRIC: ("H", [2 if s == 3 else 1]), SAMPLES: ("H", [s]), PLANAR: ("H", [1]), PREDICTOR: ("H", [2 if predictor else 1])}
        tags |= {TILE_WIDTH: ("I", [tw]), TILE_HEIGHT: ("I", [th]), TILE_OFFSETS: ("I", offsets), TILE_COUNTS: ("I", counts)} if tile else {STRIP_OFFSETS: ("I", offsets), ROWS_PER_STRIP: ("I", [th]), STRIP_COUNTS: ("I", counts)}
        entries = bytearray()
        for tag, (kind, values) in sorted(tags.items()):
            body = struct.pack(f"{order}{len(values)}{kind}", *values)
            if len(body) > 4:
                place = len(out)
                out += body + b"\0" * (len(body) % 2)
                body = struct.pack(f"{order}I", place)
            entries += struct.pack(f"{order}HHI", tag, 3 if kind == "H" else 4, len(values)) + body.ljust(4, b"\0")
        struct.pack_into(f"{order}I", out, link, len(out))
        out += struct.pack(f"{order}H", len(tags)) + entries
        link = len(out)
        out += struct.pack(f"{order}I", 0)
    return bytes(out)


def explode_pages(df: DataFrame, content: str = "content") -> DataFrame:
    """One row for each page of the files in a binary column: df's other columns, then page_no, width, height, samples, coding,
    pixels (interleaved bytes), error.

    A page that is damaged or isn't supported gives a row with error set and no pixels, and so does a null or empty file or
    one whose directories break off; other pages of the file aren't lost. bits: of a sample, see _page for pixels. Columns
    of df with an output's name are dropped. Rows of a file stay together, in order; no shuffle. Memory: one file and its page.
    """
    names = [x.split()[0] for x in PAGE.split(", ")]
    cols = [c for c in df.columns if c != content and c not in names]
    schema = T.StructType(df.select(*cols).schema.fields + T.StructType.fromDDL(PAGE).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int32()] * 6, pa.binary(), pa.string()]
        for batch in batches:
            rows, pages, held = [], [], 0

            def flush() -> pa.RecordBatch:
                kept = batch.select(cols).take(pa.array(rows, pa.int64())) if cols else None
                data = ([kept.column(c) for c in cols] if cols else []) + [pa.array([p[k] for p in pages], kind) for k, kind in enumerate(kinds)]
                return pa.RecordBatch.from_arrays(data, names=[*cols, *names])

            for r, data in enumerate(batch.column(content)):
                n = 0
                try:
                    for p in walk(data.as_py() or b""):
                        rows.append(r)
                        if isinstance(p, ValueError):
                            pages.append((n, None, None, None, None, None, None, str(p)))
                        else:
                            pages.append((n, p.width, p.height, p.samples, p.bits, p.coding, p.pixels, None))
                            held += len(p.pixels)
                        n += 1
                        if held > 4_000_000:
                            yield flush()
                            rows, pages, held = [], [], 0
                except ValueError as e:
                    rows.append(r)
                    pages.append((n, None, None, None, None, None, None, str(e)))
            if rows:
                yield flush()

    return df.select(*cols, content).mapInArrow(run, schema)


#: Bytes of a row of 64 three-sample pixels, and rows of a page of a stored payload at most.
ROW, PAGE_ROWS = 192, 1024


def payload_of(text: bytes) -> bytes:
    """The bytes and spaces up to a positive multiple of ROW."""
    return text.ljust(max(ROW, -(-len(text) // ROW) * ROW), b" ")


def store_payload(payload: bytes, coding: str = "deflate") -> bytes:
    """The payload as rows of 64 RGB pixels, on as many pages as it takes."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW // 3, 3)
    return write_pages([rows[k : k + PAGE_ROWS] for k in range(0, len(rows), PAGE_ROWS)], coding)


def average_hash(page: np.ndarray) -> str:
    """64 bits: which of 8 x 8 blocks are lighter than their mean, from blocks of near equal size."""
    gray = page.mean(axis=2)
    ys, xs = np.arange(8) * gray.shape[0] // 8, np.arange(8) * gray.shape[1] // 8
    sums = np.add.reduceat(np.add.reduceat(gray, ys, axis=0), xs, axis=1)
    area = np.outer(np.maximum(np.diff([*ys, gray.shape[0]]), 1), np.maximum(np.diff([*xs, gray.shape[1]]), 1))
    means = sums / area
    return f"{int.from_bytes(np.packbits(means > means.mean()).tobytes(), 'big'):016x}"


def document_media(df: DataFrame, coding: str = "deflate") -> DataFrame:
    """Stores each text as a TIFF and describes it from the pages read back.

    doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the payload's last 16 bytes), media_bytes, media_sha256,
    feature (each page's size and average hash). Null text counts as empty: one row of spaces. One row for each row of df.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(iter([batch]), "text", 1_000_000):
                part = part.combine_chunks().to_batches()[0]
                texts = [t.encode() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([store_payload(payload_of(t), coding) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "content"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

        def close() -> None:
            if held:
                out.append({k: held[k] for k in ("doc_id", "n_bytes", "media_bytes", "media_sha256")} | {"payload_bytes": held["n"], "payload_sha256": held["sha"].hexdigest(), "tail_crc32": zlib.crc32(held["tail"]), "feature": ";".join(held["pages"])})

        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], k) for c, k in zip(names, kinds, strict=True)], names=names)

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["error"]:
                    raise ValueError(f"document {row['doc_id']}: {row['error']}")
                if row["page_no"] == 0:
                    close()
                    held = row | {"n": 0, "sha": hashlib.sha256(), "tail": b"", "pages": []}
                pixels = row["pixels"]
                held["n"] += len(pixels)
                held["sha"].update(pixels)
                held["tail"] = (held["tail"] + pixels[-16:])[-16:]
                held["pages"].append(f"{row['width']}x{row['height']}:{average_hash(np.frombuffer(pixels, np.uint8).reshape(row['height'], row['width'], -1))}")
            if len(out) >= 2000:
                yield flush()
                out.clear()
        close()
        if out:
            yield flush()

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    media = rows.mapInArrow(store, "doc_id long, n_bytes long, content binary").select("*", F.length("content").cast("long").alias("media_bytes"), F.sha2("content", 256).alias("media_sha256"))
    return explode_pages(media).mapInArrow(digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
