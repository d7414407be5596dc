"""Media columns: baseline JPEG written and read with numpy.

Reading parses the markers, Huffman-decodes the scan and reconstructs a
thumbnail of the luminance from the DC coefficients alone.  Restart intervals
are independent of each other, so those of an Arrow slice are decoded in
lockstep, ``LANES`` at a time: one array position for each interval, one symbol
of each a step.

Writing stores bytes without loss.  A JPEG's samples pass through a rounded
cosine transform, so the lossless unit of the format is the 8 by 8 block of
quantised coefficients: 64 bytes are the coefficients of a block, in zigzag
order.  A byte is a coefficient other than zero (-128 to -1, 1 to 128).  A
comment segment holds how many bytes there are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loomwright.llm.arrow import as_text, slices

BLOCK = 64
#: Blocks between restart markers.
INTERVAL = 4
#: Intervals that are written or read at a time: what numpy holds for them doesn't grow with an image.
LANES = 4096
COMMENT = b"bytes:"

#: Code lengths (how many codes have 1, 2, ... 16 bits) and symbols.  DC: the
#: usual luminance table of the standard (fixed values).  AC: a coefficient of s
#: bits has a code of 9 - s bits, so that each takes 9; then the end of block.
DC_TABLE = ((0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0), tuple(range(12)))
AC_TABLE = ((1,) * 9 + (0,) * 7, (8, 7, 6, 5, 4, 3, 2, 1, 0))


def huffman_codes(table: tuple[tuple[int, ...], tuple[int, ...]]) -> dict[int, tuple[int, int]]:
    """symbol: (code, length), by the standard's order."""
    out, code, symbols = {}, 0, iter(table[1])
    for length, count in enumerate(table[0], 1):
        for _ in range(count):
            out[next(symbols)] = (code, length)
            code += 1
        code <<= 1
    return out


def huffman_lookup(table: tuple[tuple[int, ...], tuple[int, ...]]) -> np.ndarray:
    """For the next 16 bits: length * 256 + symbol (0: no code)."""
    out = np.zeros(1 << 16, np.int32)
    for symbol, (code, length) in huffman_codes(table).items():
        out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return out


def _bits_of(values: np.ndarray) -> np.ndarray:
    """How many bits the magnitude has."""
    return np.frexp(np.abs(values).astype(np.float64))[1].astype(np.int64)


# ---------------------------------------------------------------- writing


def _pack(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bit strings to bytes, padded with ones: the flat bytes and each row's length."""
    n, steps = codes.shape
    total = sizes.sum(1)
    lengths = (total + 7) // 8
    words = np.zeros((n, int(total.max()) // 32 + 2), ">u4")
    kept, bits, at = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(steps):
        size = sizes[:, k]
        kept = (kept << size.astype(np.uint64)) | codes[:, k].astype(np.uint64)
        bits += size
        if len(full := np.flatnonzero(bits >= 32)):
            bits[full] -= 32
            words[full, at[full]] = (kept[full] >> bits[full].astype(np.uint64)).astype(np.uint32)
            at[full] += 1
    rest = (32 - bits).astype(np.uint64)
    words[np.arange(n), at] = ((kept << rest) | ((np.uint64(1) << rest) - np.uint64(1))).astype(np.uint32)
    grid = words.view(np.uint8).reshape(n, -1)
    return grid[np.arange(grid.shape[1]) < lengths[:, None]], lengths


def header(width: int, height: int, n_bytes: int) -> bytes:
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    table = lambda kind, t: bytes([kind]) + bytes(t[0]) + bytes(t[1])
    return (
        b"\xff\xd8"
        + segment(0xFE, COMMENT + str(n_bytes).encode())
        + segment(0xDB, b"\0" + b"\1" * 64)
        + segment(0xC0, struct.pack(">BHHB", 8, height, width, 1) + b"\1\x11\0")
        + segment(0xC4, table(0x00, DC_TABLE) + table(0x10, AC_TABLE))
        + segment(0xDD, struct.pack(">H", INTERVAL))
        + segment(0xDA, b"\1\1\0\0\x3f\0")
    )


def write_images(payloads: list[bytes]) -> list[bytes]:
    """A grey JPEG for each payload (of a positive multiple of 64 bytes)."""
    if not payloads:
        return []
    counts = np.array([len(p) // BLOCK for p in payloads])
    wide = np.ceil(np.sqrt(counts)).astype(np.int64)
    high = -(-counts // wide)
    cells = wide * high
    lanes = -(-cells // INTERVAL)
    first_lane = np.cumsum(lanes) - lanes
    first_block = np.cumsum(counts) - counts
    data = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, BLOCK)
    parts, sizes = [], []
    for a in range(0, int(lanes.sum()), LANES):
        lane = np.arange(a, min(a + LANES, int(lanes.sum())))
        image = np.searchsorted(first_lane, lane, "right") - 1
        number = lane - first_lane[image]
        # Every image starts with an interval of its own.
        local = (number[:, None] * INTERVAL + np.arange(INTERVAL)).reshape(-1)
        of = np.repeat(image, INTERVAL)
        used = local < counts[of]
        part, size = _intervals(data[(first_block[of] + local)[used]], used, local < cells[of], number, number == lanes[image] - 1)
        parts.append(part.tobytes())
        sizes.append(size)
    body = memoryview(b"".join(parts))
    ends = np.cumsum(np.concatenate(sizes))
    last = ends[first_lane + lanes - 1]
    return [
        b"".join((header(int(w) * 8, int(h) * 8, len(p)), body[a:b]))
        for w, h, p, a, b in zip(wide, high, payloads, [0, *last.tolist()], last.tolist(), strict=False)
    ]


def _intervals(data: np.ndarray, used: np.ndarray, cell: np.ndarray, number: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Restart intervals with the markers that end them: the flat bytes and each one's length.

    ``data`` are the bytes of the blocks that are ``used``; other blocks of the
    picture (``cell``) are empty, those outside of it aren't stored.  ``number``
    counts the intervals of an image, its ``last`` one ends the file.
    """
    coefficients = np.zeros((len(used), BLOCK), np.int64)
    coefficients[used] = data.astype(np.int64) - 128 + (data >= 128)
    coefficients[:, 0] = np.diff(coefficients[:, 0].reshape(-1, INTERVAL), axis=1, prepend=0).reshape(-1)
    bits = _bits_of(coefficients)
    codes = np.zeros((12, 2, 2), np.int64)
    for kind, table in enumerate((DC_TABLE, AC_TABLE)):
        for symbol, (code, length) in huffman_codes(table).items():
            codes[symbol, kind] = code, length
    kind = np.zeros(BLOCK, np.int64)
    kind[1:] = 1
    value = np.where(coefficients < 0, coefficients + (1 << bits) - 1, coefficients)
    word = codes[bits, kind, 0] << bits | value
    size = codes[bits, kind, 1] + bits
    size[~used, 1:] = 0
    size[~used, 1], word[~used, 1] = codes[0, 1, 1], codes[0, 1, 0]  # the end of an empty block
    size[~cell] = 0
    word[size == 0] = 0
    flat, lengths = _pack(word.reshape(-1, INTERVAL * BLOCK), size.reshape(-1, INTERVAL * BLOCK))

    # A byte of ones is followed by a zero; markers part the intervals, the last is the end.
    ones = flat == 0xFF
    lane = np.repeat(np.arange(len(lengths)), lengths)
    stuffed = lengths + np.bincount(lane, ones, len(lengths)).astype(np.int64)
    ends = np.cumsum(stuffed + 2)
    out = np.zeros(int(ends[-1]), np.uint8)
    out[np.arange(len(flat)) + np.cumsum(ones) - ones + 2 * lane] = flat
    out[ends - 2] = 0xFF
    out[ends - 1] = np.where(last, 0xD9, 0xD0 + number % 8)
    return out, stuffed + 2


# ---------------------------------------------------------------- reading


@dataclass
class Image:
    """What the markers of one file say."""

    width: int = 0
    height: int = 0
    #: (id, horizontal, vertical, quantisation table) of each component.
    components: list[tuple[int, int, int, int]] = field(default_factory=list)
    quantisation: dict[int, tuple[int, ...]] = field(default_factory=dict)
    tables: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = field(default_factory=dict)
    restart: int = 0
    comment: bytes = b""
    #: component: (DC table, AC table) of the scan.
    scan: list[tuple[int, int, int]] = field(default_factory=list)
    data: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint8))

    def layout(self) -> tuple:
        """The blocks of a minimum coded unit: (component, DC table, AC table) each."""
        if len(self.scan) == 1:
            sizes = [(0, 1, 1)]
        else:
            sizes = [(i, h, v) for i, (_, h, v, _) in enumerate(self.components)]
        return tuple((i, self.tables[self.scan[i][1]], self.tables[0x10 | self.scan[i][2]]) for i, h, v in sizes for _ in range(h * v))

    def units(self) -> tuple[int, int]:
        h = max(c[1] for c in self.components) if len(self.scan) > 1 else 1
        v = max(c[2] for c in self.components) if len(self.scan) > 1 else 1
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))


def parse(raw: bytes) -> Image:
    """The segments of a baseline JPEG with one scan; ValueError for anything else."""
    if raw[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    image, at = Image(), 2
    while at + 4 <= len(raw):
        if raw[at] != 0xFF:
            raise ValueError("no marker")
        marker = raw[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        body = raw[at + 4 : at + 2 + int.from_bytes(raw[at + 2 : at + 4], "big")]
        at += 2 + int.from_bytes(raw[at + 2 : at + 4], "big")
        if marker == 0xC0:
            precision, image.height, image.width, n = struct.unpack(">BHHB", body[:6])
            if precision != 8 or not image.width or not image.height:
                raise ValueError("not 8 bits, or no size")
            image.components = [(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * n, 3)]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not baseline")
        elif marker == 0xDB:
            while body:
                size = 128 if body[0] >> 4 else 64
                image.quantisation[body[0] & 15] = struct.unpack(f">64{'H' if size == 128 else 'B'}", body[1 : 1 + size])
                body = body[1 + size :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                image.tables[body[0]] = (tuple(body[1:17]), tuple(body[17 : 17 + n]))
                body = body[17 + n :]
        elif marker == 0xDD:
            image.restart = int.from_bytes(body[:2], "big")
        elif marker == 0xFE:
            image.comment = body
        elif marker == 0xDA:
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            image.scan = [(c[0], chosen[c[0]] >> 4, chosen[c[0]] & 15) for c in image.components if c[0] in chosen]
            if len(image.scan) != len(image.components):
                raise ValueError("a scan for some components only")
            image.data = np.frombuffer(raw, np.uint8, offset=at)
            image.layout()
            return image
    raise ValueError("no scan")


def decode_scans(images: list[Image]) -> list[np.ndarray]:
    """The quantised coefficients (blocks by 64, in zigzag order) of images with one layout.

    The blocks are in the order of the scan.
    """
    layout = images[0].layout()
    per_unit = len(layout)
    tables = list(dict.fromkeys(t for _, dc, ac in layout for t in (dc, ac)))
    lookup = np.stack([huffman_lookup(t) for t in tables])
    choice = np.array([[tables.index(dc), tables.index(ac)] for _, dc, ac in layout])
    component = np.array([i for i, _, _ in layout])

    # Bytes without stuffing, and where each interval starts; restart markers end one.
    chunks, starts, blocks, base, first = [], [], [], 0, []
    total = 0
    for image in images:
        data = image.data
        at = np.flatnonzero(data[:-1] == 0xFF)
        after = data[at + 1]
        end = at[(after != 0) & (after != 0xFF) & ((after < 0xD0) | (after > 0xD7))]
        end = int(end[0]) if len(end) else len(data)
        inside = at < end
        at, after = at[inside], after[inside]
        restarts = at[(after >= 0xD0) & (after <= 0xD7)]
        drop = np.zeros(end, bool)
        drop[(at + 1)[after == 0]] = True
        drop[restarts], drop[restarts + 1] = True, True
        begins = np.r_[0, restarts - np.searchsorted(np.flatnonzero(drop), restarts)]
        chunks.append(data[:end][~drop])
        units = image.units()[0] * image.units()[1]
        each = image.restart or units
        n = -(-units // each)
        if len(begins) < n:
            raise ValueError("restart markers are missing")
        starts.append((base + begins[:n]) * 8)
        blocks.append(np.minimum(each, units - each * np.arange(n)) * per_unit)
        base += len(chunks[-1])
        first.append(total)
        total += units * per_unit
    flat = np.concatenate([*chunks, np.full(16, 0xFF, np.uint8)])
    windows = np.ndarray((len(flat) - 7,), ">u8", flat, strides=(1,))

    starts, blocks = np.concatenate(starts), np.concatenate(blocks)
    out = np.zeros((total, BLOCK), np.int16)
    block = np.cumsum(blocks) - blocks
    for a in range(0, len(starts), LANES):
        piece = slice(a, a + LANES)
        _decode_lanes(windows, starts[piece], blocks[piece].copy(), block[piece].copy(), 8 * base, lookup, choice, component, out)
    return [out[a:b] for a, b in zip(first, [*first[1:], total], strict=True)]


def _decode_lanes(
    windows: np.ndarray, at: np.ndarray, left: np.ndarray, block: np.ndarray, limit: int,
    lookup: np.ndarray, choice: np.ndarray, component: np.ndarray, out: np.ndarray,
) -> None:
    """Decode intervals in lockstep: ``left`` blocks each from bit ``at`` on, written to ``out`` from ``block`` on."""
    per_unit = len(component)
    k = np.zeros(len(at), np.int64)
    done = np.zeros(len(at), np.int64)
    previous = np.zeros((len(at), int(component.max()) + 1), np.int64)
    while len(at):
        unit = done % per_unit
        word = windows[at >> 3].astype(np.uint64)
        shift = at & 7
        ac = (k > 0).astype(np.int64)
        entry = lookup[choice[unit, ac], ((word >> (48 - shift).astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.int64)]
        length, symbol = entry >> 8, entry & 255
        bits = symbol & 15
        if not length.all() or (at > limit).any():
            raise ValueError("no such code")
        value = ((word >> (64 - shift - length - bits).clip(0, 63).astype(np.uint64)).astype(np.int64)) & ((1 << bits) - 1)
        value = np.where((bits > 0) & (value < (1 << np.maximum(bits - 1, 0))), value - (1 << bits) + 1, value)
        at = at + length + bits
        run = symbol >> 4
        is_dc = ac == 0
        if is_dc.any():
            rows = np.flatnonzero(is_dc)
            who = component[unit[rows]]
            previous[rows, who] += value[rows]
            out[block[rows], 0] = previous[rows, who]
            k[rows] = 1
        if not is_dc.all():
            rows = np.flatnonzero(~is_dc)
            to = k[rows] + run[rows]
            some = bits[rows] > 0
            if (to[some] >= BLOCK).any():
                raise ValueError("a run past the block")
            out[block[rows[some]], to[some]] = value[rows[some]]
            k[rows] = np.where(some, to + 1, np.where(run[rows] == 15, k[rows] + 16, BLOCK))
        ended = k >= BLOCK
        if ended.any():
            k[ended] = 0
            block[ended] += 1
            done[ended] += 1
            left[ended] -= 1
            if not left.all():
                go = left > 0
                at, left, block, k, done, previous = at[go], left[go], block[go], k[go], done[go], previous[go]


def thumbnail(image: Image, coefficients: np.ndarray) -> np.ndarray:
    """One grey pixel for each 8 by 8 block of the first component, from its DC coefficient."""
    across, down = image.units()
    h, v = (image.components[0][1], image.components[0][2]) if len(image.scan) > 1 else (1, 1)
    per_unit = len(image.layout())
    dc = coefficients[:, 0].reshape(down, across, per_unit)[:, :, : h * v].reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
    step = image.quantisation[image.components[0][3]][0]
    pixels = np.clip((dc.astype(np.int64) * step + 4) // 8 + 128, 0, 255).astype(np.uint8)
    top_h, top_v = (max(c[1] for c in image.components), max(c[2] for c in image.components)) if len(image.scan) > 1 else (1, 1)
    return pixels[: -(-image.height * v // (8 * top_v)), : -(-image.width * h // (8 * top_h))]


def average_hash(pixels: np.ndarray) -> str:
    """64 bits: which cells of an 8 by 8 grid over the thumbnail are brighter than its mean."""
    rows, columns = (np.minimum(np.arange(9) * n // 8, n - 1) for n in pixels.shape)
    sums = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1), np.int64)
    sums[1:, 1:] = pixels.astype(np.int64).cumsum(0).cumsum(1)
    r0, c0 = rows[:-1], columns[:-1]
    r1, c1 = np.maximum(rows[1:], r0 + 1), np.maximum(columns[1:], c0 + 1)
    area = (r1 - r0)[:, None] * (c1 - c0)[None, :]
    cell = sums[np.ix_(r1, c1)] - sums[np.ix_(r0, c1)] - sums[np.ix_(r1, c0)] + sums[np.ix_(r0, c0)]
    brighter = cell * pixels.size > int(pixels.astype(np.int64).sum()) * area
    return np.packbits(brighter.reshape(-1)).tobytes().hex()


@dataclass
class Media:
    width: int | None = None
    height: int | None = None
    thumbnail: bytes | None = None
    thumbnail_hash: str | None = None
    payload: bytes | None = None
    error: str | None = None


def read_images(files: list[bytes]) -> list[Media]:
    """Size, thumbnail and payload of each file; files that aren't baseline JPEG have ``error``."""
    out = [Media() for _ in files]
    groups: dict[tuple, list[tuple[int, Image]]] = {}
    for i, raw in enumerate(files):
        try:
            image = parse(raw)
            groups.setdefault(image.layout(), []).append((i, image))
        except (ValueError, KeyError, IndexError, struct.error) as e:
            out[i].error = str(e) or "cut off"
    for members in groups.values():
        try:
            decoded = decode_scans([image for _, image in members])
        except ValueError:  # one of them is damaged: find out which
            decoded = []
            for i, image in members:
                try:
                    decoded += decode_scans([image])
                except ValueError as e:
                    decoded.append(None)
                    out[i].error = str(e)
        for (i, image), coefficients in zip(members, decoded, strict=True):
            if coefficients is None:
                continue
            pixels = thumbnail(image, coefficients)
            out[i].width, out[i].height = image.width, image.height
            out[i].thumbnail, out[i].thumbnail_hash = pixels.tobytes(), average_hash(pixels)
            if image.comment.startswith(COMMENT):
                n = int(image.comment[len(COMMENT) :])
                values = coefficients[: n // BLOCK]
                out[i].payload = b"".join(
                    (part + 128 - (part > 0)).astype(np.uint8).tobytes() for part in (values[a : a + LANES] for a in range(0, len(values), LANES))
                )
    return out


# ---------------------------------------------------------------- columns


def media_columns(files: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """From (id, JPEG file) to id, width, height, thumbnail, thumbnail_hash, payload, error.

    Null or damaged files have an ``error`` and nulls; empty tables give empty results.
    """
    rows = files.select(files[id_col].alias("id"), files[media_col].cast("binary").alias("media"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media"):
                found = read_images([x or b"" for x in part.column("media").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), *_arrays(found)], ["id", *_NAMES])

    return rows.mapInArrow(work, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", id_col)


_NAMES = ("width", "height", "thumbnail", "thumbnail_hash", "payload", "error")
_SCHEMA = "width int, height int, thumbnail binary, thumbnail_hash string, payload binary, error string"
_TYPES = (pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.binary(), pa.string())


def _arrays(found: list[Media]) -> list[pa.Array]:
    return [pa.array([getattr(m, name) for m in found], kind) for name, kind in zip(_NAMES, _TYPES, strict=True)]


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a JPEG, and what is read back: id, n_bytes, media and the columns of media_columns.

    A text's UTF-8 bytes are filled up with zeros to a positive multiple of 64;
    null text counts as empty (one block of zeros).  Texts are stored whole and
    repeated rows each; other columns aren't read.  An empty table gives an
    empty result.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw = as_text(part.column("text")).cast(pa.large_binary())
                payloads = (x.as_py() for x in raw)
                files = write_images([x + bytes(-len(x) % BLOCK if x else BLOCK) for x in payloads])
                arrays = [part.column("id"), pc.binary_length(raw).cast(pa.int64()), pa.array(files, pa.binary()), *_arrays(read_images(files))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "media", *_NAMES])

    return rows.mapInArrow(work, f"id {kind}, n_bytes long, media binary, {_SCHEMA}").withColumnRenamed("id", id_col)
