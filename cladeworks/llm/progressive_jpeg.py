"""Media columns of progressive JPEG: coefficients from scans, pixels in numpy.

``decode`` accumulates the scans of a progressive JPEG (spectral selection and successive
approximation, Huffman coded, with or without restarts and interleaving) into coefficient arrays.
``to_rgb`` dequantises, inverse-transforms all blocks with one matrix, repeats chroma up to full
resolution and converts to RGB. ``encode`` writes coefficient arrays as a progressive JPEG.

Scans whose Huffman table leaves no choice have a constant stride and are read as whole arrays; so are
refinements of coefficients that are all nonzero. Everything else goes through a bit reader.

Bytes are stored losslessly in coefficients, JPEG's unit: a block of 64 takes 64 bytes. A DC
coefficient is its byte; an AC coefficient is its byte b if b >= 128 and b - 255 if not, which are all
the values of size 8. 4:2:0 minimum coded units of six blocks are filled in order.

Defined results: null and empty texts store 64 zero bytes; texts of any length up to 6 GB are stored
whole; repeated texts give equal columns; a damaged file raises ``ValueError``; other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cladeworks.runtime import read_table

BLOCK = 64
MCU_BLOCKS = 6
MOST_MCUS = 4095
MOST_RUN = 32767
#: Bits of the DC coefficients that come by refinement.
DC_BITS = 8
BANDS = ((0, 1, 5), (0, 6, 63), (1, 1, 63), (2, 1, 63))
NEXT_MARKER = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]")
#: Tasks turn pixels of so many blocks at once.
PIXEL_BLOCKS = 1 << 14


@cache
def zigzag() -> np.ndarray:
    """Place in the row-major block of each coefficient of a scan."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


@cache
def inverse_transform() -> np.ndarray:
    """(64, 64): zigzag coefficients to row-major samples."""
    n = np.arange(8)
    basis = np.cos((2 * n[:, None] + 1) * n[None, :] * np.pi / 16) * np.where(n == 0, np.sqrt(0.5), 1.0) / 2
    both = np.einsum("xu,yv->uvxy", basis, basis).reshape(64, 64)
    return np.ascontiguousarray(both[zigzag()]).astype(np.float32)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, slot: int, lengths: dict[int, int]) -> bytes:
    counts = [sum(n == i for n in lengths.values()) for i in range(1, 17)]
    return _segment(0xC4, bytes([kind << 4 | slot, *counts, *sorted(lengths, key=lambda s: (lengths[s], s))]))


@cache
def _scan_head(parts: tuple[int, ...], start: int, end: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for p in parts for x in (p + 1, 0)), start, end, high << 4 | low]))


def _stuff(data: bytes) -> bytes:
    return data.replace(b"\xff", b"\xff\x00")


def _pack(bits: np.ndarray) -> bytes:
    """Bits to bytes, filled up with ones."""
    left = -len(bits) % 8
    return _stuff(np.packbits(np.concatenate([bits, np.ones(left, np.uint8)]) if left else bits).tobytes())


@cache
def _run_bits(blocks: int) -> tuple[bytes, tuple[tuple[int, np.ndarray], ...]]:
    """Table and prefixes of the end-of-band runs over ``blocks`` blocks."""
    runs = [MOST_RUN] * (blocks // MOST_RUN) + [blocks % MOST_RUN] * (blocks % MOST_RUN > 0)
    sizes = sorted({r.bit_length() - 1 for r in runs}, reverse=True)
    codes = {s: "1" * i + "0" for i, s in enumerate(sizes)}

    def prefix(run: int) -> np.ndarray:
        size = run.bit_length() - 1
        extra = f"{run - (1 << size):0{size}b}" if size else ""
        return np.array([int(x) for x in codes[size] + extra], dtype=np.uint8)

    prefixes = [(r, prefix(r)) for r in runs]
    return _huffman(1, 0, {s << 4: len(codes[s]) for s in sizes}), tuple(prefixes)


@cache
def _frame_head(width: int, height: int) -> bytes:
    table = _segment(0xDB, bytes([0]) + b"\x01" * 64)
    frame = _segment(0xC2, struct.pack(">BHHB", 8, 16 * height, 16 * width, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    return b"\xff\xd8" + table + frame + _huffman(0, 0, {0: 1}) + _scan_head((0, 1, 2), 0, 0, 0, DC_BITS)


AC_TABLE = _huffman(1, 0, {7: 1})


def grid(blocks: int) -> tuple[int, int]:
    """Units across and down for so many blocks of payload."""
    units = -(-blocks // MCU_BLOCKS)
    high = -(-units // MOST_MCUS)
    return -(-units // high), high


def _planes(units: np.ndarray, width: int, height: int) -> list[np.ndarray]:
    """Blocks by component in raster order, from blocks in the order of the units."""
    cells = units.reshape(height, width, MCU_BLOCKS, -1)
    luma = cells[:, :, :4].reshape(height, width, 2, 2, -1).transpose(0, 2, 1, 3, 4).reshape(4 * height * width, -1)
    return [luma, cells[:, :, 4].reshape(height * width, -1), cells[:, :, 5].reshape(height * width, -1)]


def _units(planes: list[np.ndarray], width: int, height: int) -> np.ndarray:
    luma = planes[0].reshape(height, 2, width, 2, -1).transpose(0, 2, 1, 3, 4).reshape(height, width, 4, -1)
    rest = [p.reshape(height, width, 1, -1) for p in planes[1:]]
    return np.concatenate([luma, *rest], axis=2).reshape(MCU_BLOCKS * height * width, -1)


def store(payload: bytes) -> bytes:
    """A progressive JPEG whose coefficients hold ``payload``, a positive multiple of 64 bytes."""
    width, height = grid(len(payload) // BLOCK)
    units = np.zeros((MCU_BLOCKS * width * height, BLOCK), dtype=np.uint8)
    units.reshape(-1)[: len(payload)] = np.frombuffer(payload, dtype=np.uint8)
    out = [_frame_head(width, height), _pack(np.zeros(len(units), dtype=np.uint8))]
    dc = np.packbits(np.pad(np.unpackbits(units[:, :1], axis=1), ((0, -len(units) % 8), (0, 0)), constant_values=1).T, axis=1)
    for bit in range(DC_BITS):
        out += [_scan_head((0, 1, 2), 0, 0, DC_BITS - bit, DC_BITS - bit - 1), _stuff(dc[bit].tobytes())]
    # First scans hold sign and size-7 bits, which are the byte's upper seven; refinements the magnitude's last bit.
    first, last = _planes(units >> 1, width, height), _planes((units ^ (units < 128)) & 1, width, height)
    out.append(AC_TABLE)
    for part, start, end in BANDS:
        out += [_scan_head((part,), start, end, 0, 1), first[part][:, start : end + 1].tobytes()]
    for part, start, end in BANDS:
        bits, at, pieces = last[part][:, start : end + 1], 0, []
        table, runs = _run_bits(len(bits))
        for run, prefix in runs:
            pieces += [prefix, bits[at : at + run].reshape(-1)]
            at += run
        out += [table, _scan_head((part,), start, end, 1, 0), _pack(np.concatenate(pieces))]
    out.append(b"\xff\xd9")
    return b"".join(out)


class _Bits:
    """Bit reader over the unstuffed data of a scan or restart interval."""

    def __init__(self, data: bytes):
        self.data, self.at, self.size = data, 0, 8 * len(data)

    def take(self, n: int) -> int:
        if n == 0:
            return 0
        at, end = self.at, self.at + n
        if end > self.size:
            raise ValueError("a scan ends early")
        first, last = at >> 3, (end + 7) >> 3
        self.at = end
        return int.from_bytes(self.data[first:last], "big") >> (8 * last - end) & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("no such Huffman code")


def _signed(bits: int, size: int) -> int:
    return bits if size == 0 or bits >> (size - 1) else bits - (1 << size) + 1


class Image:
    """Frame parameters and the coefficients gathered so far: per component (blocks down, blocks across, 64)."""

    def __init__(self, body: bytes):
        depth, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        if depth != 8 or len(body) < 6 + 3 * n or not self.width or not self.height:
            raise ValueError("not an 8-bit frame")
        self.ids = [body[6 + 3 * i] for i in range(n)]
        self.factors = [(body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15) for i in range(n)]
        self.quantisers = [body[8 + 3 * i] for i in range(n)]
        self.across, self.down = max(h for h, _ in self.factors), max(v for _, v in self.factors)
        self.units = (-(-self.height // (8 * self.down)), -(-self.width // (8 * self.across)))
        self.coefficients = [np.zeros((self.units[0] * v, self.units[1] * h, 64), dtype=np.int16) for h, v in self.factors]
        self.tables: dict[int, np.ndarray] = {}
        self._orders: dict[tuple[int, ...], list] = {}

    def own_blocks(self, part: int) -> tuple[int, int]:
        """Blocks down and across of a component in a scan of its own."""
        h, v = self.factors[part]
        return -(-(-(-self.height * v // self.down)) // 8), -(-(-(-self.width * h // self.across)) // 8)

    def order(self, parts: list[int]) -> list[tuple[int, np.ndarray]]:
        """For each block of a unit of an interleaved scan, its component and its flat index by unit."""
        if tuple(parts) in self._orders:
            return self._orders[tuple(parts)]
        rows, cols = self.units
        r, c = np.divmod(np.arange(rows * cols), cols)
        out = []
        for p in parts:
            h, v = self.factors[p]
            out += [(p, (r * v + y) * (cols * h) + c * h + x) for y in range(v) for x in range(h)]
        self._orders[tuple(parts)] = out
        return out


def decode(data: bytes) -> Image:
    """All scans of a progressive JPEG, as coefficients in zigzag order."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    image, huffman, quantisers, restart, at = None, {}, {}, 0, 2
    while True:
        while data[at : at + 2] == b"\xff\xff":
            at += 1
        if at + 2 > len(data) or data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = data[at + 1]
        if marker == 0xD9:
            if image is None:
                raise ValueError("no frame")
            image.tables = quantisers
            return image
        end = at + 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : end]
        at = end
        if marker == 0xC4:
            while body:
                counts = body[1:17]
                n, code, k, table = sum(counts), 0, 0, {}
                for size, count in enumerate(counts, 1):
                    for _ in range(count):
                        table[size, code] = body[17 + k]
                        code, k = code + 1, k + 1
                    code <<= 1
                huffman[body[0]] = table
                body = body[17 + n :]
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], dtype=">u2" if wide else np.uint8).astype(np.float32)
                body = body[65 + 64 * wide :]
        elif marker == 0xC2:
            image = Image(body)
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xDA:
            found = NEXT_MARKER.search(data, at)
            if not found or image is None:
                raise ValueError("a scan has no end")
            _scan(image, body, data[at : found.start()], huffman, restart)
            at = found.start()
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive Huffman frame")


def _scan(image: Image, body: bytes, data: bytes, huffman: dict, restart: int) -> None:
    n = body[0]
    parts = [image.ids.index(body[1 + 2 * i]) for i in range(n)]
    slots = [body[2 + 2 * i] for i in range(n)]
    start, end, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
    if end > 63 or start > end or (start and n > 1):
        raise ValueError("a scan's band is out of range")
    if n > 1:
        blocks = image.order(parts)
        places = [(slots[parts.index(p)], image.coefficients[p].reshape(-1, 64), index, p) for p, index in blocks]
    else:
        part = parts[0]
        rows, cols = image.own_blocks(part)
        full = image.coefficients[part].shape
        index = np.arange(rows * cols) if (rows, cols) == full[:2] else (np.arange(rows)[:, None] * full[1] + np.arange(cols)).reshape(-1)
        places = [(slots[0], image.coefficients[part].reshape(-1, 64), index, part)]
    if not restart and _whole_scan(places, data, huffman, start, end, high, low):
        return
    steps = re.split(rb"\xff[\xd0-\xd7]", data) if restart else [data]
    units = len(places[0][2])
    for i, piece in enumerate(steps):
        span = range(i * restart, min(units, (i + 1) * restart)) if restart else range(units)
        _slow_scan(places, _Bits(piece.replace(b"\xff\x00", b"\xff")), span, huffman, start, end, high, low)


def _whole_scan(places: list, data: bytes, huffman: dict, start: int, end: int, high: int, low: int) -> bool:
    """Read a scan of constant stride as an array; False if it is not one."""
    data = data.replace(b"\xff\x00", b"\xff")
    units = len(places[0][2])
    total = units * len(places)
    if start == 0 and end == 0 and high:
        if 8 * len(data) < total:
            raise ValueError("a scan ends early")
        bits = np.unpackbits(np.frombuffer(data, np.uint8), count=total).reshape(units, -1)
        for i, (_, blocks, index, _) in enumerate(places):
            blocks[index, 0] |= bits[:, i].astype(np.int16) << low
        return True
    if start == 0:
        tables = [huffman.get(slot >> 4, {}) for slot, *_ in places]
        if end == 0 and all(len(t) == 1 and 0 in t.values() for t in tables):
            strides = [next(iter(t))[0] for t in tables]
            if 8 * len(data) < units * sum(strides):
                raise ValueError("a scan ends early")
            return True  # every difference is zero, and so are the values
        return False
    ((slot, blocks, index, _),) = places
    table = huffman.get(0x10 | slot & 15, {})
    band = end - start + 1
    if not high:
        if len(table) != 1:
            return False
        ((length, _), symbol), size = next(iter(table.items())), next(iter(table.values())) & 15
        if symbol >> 4 or not size:
            return False
        if 8 * len(data) < units * band * (length + size):
            raise ValueError("a scan ends early")
        if length + size == 8:
            raw = np.frombuffer(data, np.uint8, count=units * band).astype(np.int16) & ((1 << size) - 1)
        else:
            bits = np.unpackbits(np.frombuffer(data, np.uint8), count=units * band * (length + size)).reshape(-1, length + size)[:, length:]
            raw = (bits.astype(np.int16) << np.arange(size - 1, -1, -1, dtype=np.int16)).sum(axis=1, dtype=np.int16)
        value = np.where(raw >> (size - 1), raw, raw - ((1 << size) - 1)) << low
        _put(blocks, index, start, end, value.reshape(units, band))
        return True
    known = blocks[:, start : end + 1] if len(index) == len(blocks) else blocks[index, start : end + 1]
    if not known.all():
        return False
    bits, at, done, fixes = _Bits(data), 0, 0, []
    while done < units:
        symbol = bits.symbol(table)
        if symbol & 15 or symbol == 0xF0:
            return False
        size = symbol >> 4
        run = (1 << size) + bits.take(size)
        if done + run > units or bits.at + run * band > bits.size:
            raise ValueError("a scan ends early")
        at = bits.at
        first, last = at >> 3, (at + run * band + 7) >> 3
        fixes.append(np.unpackbits(np.frombuffer(data[first:last], np.uint8))[at - 8 * first :][: run * band])
        bits.at, done = at + run * band, done + run
    fix = (fixes[0] if len(fixes) == 1 else np.concatenate(fixes)).reshape(units, band).astype(np.int16) << low
    _put(blocks, index, start, end, known + np.where(known > 0, fix, -fix))
    return True


def _put(blocks: np.ndarray, index: np.ndarray, start: int, end: int, value: np.ndarray) -> None:
    if len(index) == len(blocks):
        blocks[:, start : end + 1] = value
    else:
        blocks[index, start : end + 1] = value


def _slow_scan(places: list, bits: _Bits, span: range, huffman: dict, start: int, end: int, high: int, low: int) -> None:
    before, run = {}, 0
    for unit in span:
        for slot, blocks, index, part in places:
            block = blocks[index[unit]]
            if start == 0:
                if high:
                    block[0] |= bits.take(1) << low
                else:
                    size = bits.symbol(huffman[slot >> 4])
                    before[part] = before.get(part, 0) + _signed(bits.take(size), size)
                    block[0] = before[part] << low
                if end == 0:
                    continue
                raise ValueError("a progressive scan mixes DC and AC")
            table = huffman[0x10 | slot & 15]
            if high:
                run = _refine(block, bits, table, start, end, low, run)
                continue
            if run:
                run -= 1
                continue
            k = start
            while k <= end:
                symbol = bits.symbol(table)
                zeros, size = symbol >> 4, symbol & 15
                if size:
                    k += zeros
                    if k > end:
                        raise ValueError("a run leaves its band")
                    block[k] = _signed(bits.take(size), size) * (1 << low)
                    k += 1
                elif zeros == 15:
                    k += 16
                else:
                    run = (1 << zeros) - 1 + bits.take(zeros)
                    break


def _refine(block: np.ndarray, bits: _Bits, table: dict, start: int, end: int, low: int, run: int) -> int:
    step, k = 1 << low, start

    def fix(at: int) -> None:
        if bits.take(1):
            block[at] += step if block[at] > 0 else -step

    while not run and k <= end:
        symbol = bits.symbol(table)
        zeros, size, value = symbol >> 4, symbol & 15, 0
        if size:
            value = step if bits.take(1) else -step
        elif zeros < 15:
            run = (1 << zeros) + bits.take(zeros)
            break
        while k <= end:
            if block[k]:
                fix(k)
            elif zeros == 0:
                block[k] = value
                k += 1
                break
            else:
                zeros -= 1
            k += 1
    if run:
        for at in range(k, end + 1):
            if block[at]:
                fix(at)
        run -= 1
    return run


def samples(image: Image, part: int) -> np.ndarray:
    """Samples of a component, (rows, columns) of whole blocks."""
    rows, cols, _ = image.coefficients[part].shape
    flat, out = image.coefficients[part].reshape(-1, 64), np.empty((rows * cols, 64), dtype=np.float32)
    matrix = image.tables[image.quantisers[part]][:, None] * inverse_transform()
    for at in range(0, len(flat), PIXEL_BLOCKS):
        np.matmul(flat[at : at + PIXEL_BLOCKS].astype(np.float32), matrix, out=out[at : at + PIXEL_BLOCKS])
    return out.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(8 * rows, 8 * cols)


def to_rgb(image: Image) -> np.ndarray:
    """(height, width, 3) bytes; chroma is repeated to the resolution of the frame."""
    planes = []
    for part, (h, v) in enumerate(image.factors):
        plane = samples(image, part)
        if (rate := image.down // v) > 1:
            plane = plane.repeat(rate, axis=0)
        if (rate := image.across // h) > 1:
            plane = plane.repeat(rate, axis=1)
        planes.append(plane[: image.height, : image.width])
    out = np.empty((image.height, image.width, 3), dtype=np.uint8)
    luma = planes[0] + np.float32(128.5)
    if len(planes) < 3:
        out[:] = np.clip(luma, 0, 255)[:, :, None]
        return out
    blue, red = planes[1], planes[2]
    out[:, :, 0] = np.clip(luma + np.float32(1.402) * red, 0, 255)
    out[:, :, 1] = np.clip(luma - np.float32(0.344136) * blue - np.float32(0.714136) * red, 0, 255)
    out[:, :, 2] = np.clip(luma + np.float32(1.772) * blue, 0, 255)
    return out


def stored_bytes(image: Image) -> bytes:
    """The bytes that ``store`` put into the coefficients, with the filling of the last units."""
    height, width = image.units
    values = _units([c.reshape(-1, 64) for c in image.coefficients], width, height)
    raw = (values + np.where(values < 0, np.int16(255), np.int16(0))).astype(np.uint8)
    raw[:, 0] = values[:, 0]
    return raw.tobytes()


def payload_of(text: str | None) -> tuple[bytes, int]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(max(BLOCK, -(-len(data) // BLOCK) * BLOCK) - len(data)), len(data)


def feature(rgb: np.ndarray) -> str:
    """Shape, mean colour and checksum of a tensor."""
    means = rgb.reshape(-1, 3).mean(axis=0)
    return f"{rgb.shape[0]}x{rgb.shape[1]}:" + ",".join(f"{m:.3f}" for m in means) + f":{zlib.crc32(rgb):08x}"


def store_column(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_jp_media``, a progressive JPEG of each text."""
    return _append(docs, text_col, lambda text: (store(payload_of(text)[0]),), [("_jp_media", "binary", pa.binary())])


def tensor_column(media: DataFrame, media_col: str = "_jp_media") -> DataFrame:
    """``media`` with ``_jp_rgb`` (row-major bytes), ``_jp_height`` and ``_jp_width``; nulls stay null."""

    def tensor(data: bytes | None) -> tuple:
        if data is None:
            return None, None, None
        rgb = to_rgb(decode(data))
        return rgb.tobytes(), rgb.shape[0], rgb.shape[1]

    return _append(media, media_col, tensor, [("_jp_rgb", "binary", pa.binary()), ("_jp_height", "integer", pa.int32()), ("_jp_width", "integer", pa.int32())])


def _append(df: DataFrame, col: str, make, fields: list[tuple], keep: list[str] | None = None) -> DataFrame:
    """``make(value of col)`` gives the new fields; of the old columns, those in ``keep`` stay, or all."""
    names = [c for c in df.columns if c not in {f[0] for f in fields}]
    keep = [c for c in names if keep is None or c in keep]
    schema = df.select(*keep).schema
    for name, kind, _ in fields:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [make(x.as_py()) for x in part.column(names.index(col))]
                yield pa.RecordBatch.from_arrays([*(part.column(names.index(c)) for c in keep), *(pa.array([m[i] for m in made], f[2]) for i, f in enumerate(fields))], [*keep, *(f[0] for f in fields)])

    return df.select(*names).mapInArrow(run, schema)


def digest(text: str | None) -> tuple:
    """Store a text, read the stored bytes back, and describe both."""
    payload, size = payload_of(text)
    media = store(payload)
    image = decode(media)
    back = stored_bytes(image)[: len(payload)]
    return size, len(payload), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature(to_rgb(image))


def op7_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fields = [("n_bytes", "long", pa.int64()), ("payload_bytes", "long", pa.int64()), ("payload_sha256", "string", pa.string()), ("tail_crc32", "long", pa.int64()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string())]
    return _append(docs, "text", digest, fields, keep=["doc_id"])
