from __future__ import annotations

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from loomwright.llm import media_jpeg
from loomwright.llm.media_jpeg import decode_scans, media_columns, parse, read_images, store_texts, write_images
from loomwright.llm.queries import QUERIES


def test_payloads_come_back(spark, docs, odd_rows):
    rows = store_texts(docs(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    by_id = {}
    for r in rows:
        assert r["error"] is None
        by_id.setdefault(r["doc_id"], []).append(r)
    for key, text, *_ in odd_rows:
        raw = (text or "").encode()
        want = raw + bytes(-len(raw) % 64 if raw else 64)
        assert all(bytes(r["payload"]) == want and r["n_bytes"] == len(raw) for r in by_id[key])
    assert bytes(by_id[1][0]["media"]) == bytes(by_id[2][0]["media"])
    assert store_texts(docs([])).count() == 0


def test_every_byte_survives():
    random.seed(1)
    payloads = [bytes(range(256)), random.randbytes(64 * 37), b"\xff" * 640, bytes(64)]
    assert [m.payload for m in read_images(write_images(payloads))] == payloads


def test_thumbnail_is_the_dc(spark):
    """A block's pixel is its DC coefficient over 8 about the middle grey."""
    payload = b"".join(bytes([v, *[128] * 63]) for v in (100, 150, 200, 250))
    raw = write_images([payload])[0]
    image = parse(raw)
    dc = decode_scans([image])[0][:, 0]
    assert dc.tolist() == [100 - 128, 150 - 127, 200 - 127, 250 - 127]
    found = read_images([raw])[0]
    assert (found.width, found.height) == (16, 16)
    assert np.frombuffer(found.thumbnail, np.uint8).tolist() == [(d + 4) // 8 + 128 for d in dc.tolist()]


def test_damaged_files_have_an_error(spark):
    good = write_images([b"a" * 64])[0]
    rows = spark.createDataFrame([(1, good), (2, good[:40]), (3, b"GIF89a"), (4, None), (5, good[:-6])], "doc_id long, m binary")
    found = {r["doc_id"]: r for r in media_columns(rows, "doc_id", "m").collect()}
    assert found[1]["error"] is None and bytes(found[1]["payload"]) == b"a" * 64
    assert all(found[k]["error"] for k in (2, 3, 4))


# ---------------------------------------------------------------- a plain coder, a bit at a time


def plain_codes(counts, symbols):
    """symbol: its code as text of 0 and 1."""
    out, code, left = {}, 0, list(symbols)
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[left.pop(0)] = f"{code:0{length}b}"
            code += 1
        code *= 2
    return out


def plain_file(width, height, parts, units, tables, restart=0, comment=b"", wide=False):
    """A baseline JPEG.  parts: (h, v, table number) of each component; units: per unit the blocks of 64 coefficients in zigzag order."""
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    out = b"\xff\xd8" + (segment(0xFE, comment) if comment else b"")
    out += segment(0xDB, b"\x10" + struct.pack(">64H", *([300] * 64)) if wide else b"\0" + b"\1" * 64)
    out += segment(0xC0, struct.pack(">BHHB", 8, height, width, len(parts)) + b"".join(bytes([i, h << 4 | v, 0]) for i, (h, v, _) in enumerate(parts, 1)))
    out += segment(0xC4, b"".join(bytes([kind << 4 | i]) + bytes(t[0]) + bytes(t[1]) for i, pair in enumerate(tables) for kind, t in enumerate(pair)))
    out += segment(0xDD, struct.pack(">H", restart)) if restart else b""
    out += segment(0xDA, bytes([len(parts)]) + b"".join(bytes([i, t << 4 | t]) for i, (_, _, t) in enumerate(parts, 1)) + b"\0\x3f\0")
    codes = [[plain_codes(*t) for t in pair] for pair in tables]
    layout = [i for i, (h, v, _) in enumerate(parts) for _ in range(h * v if len(parts) > 1 else 1)]
    every = restart or len(units)
    for a in range(0, len(units), every):
        bits, last = "", [0] * len(parts)
        for unit in units[a : a + every]:
            for i, block in zip(layout, unit, strict=True):
                dc, ac = codes[parts[i][2]]
                if block is None:  # no coefficient but the DC term of the block before
                    block = [0, *[0] * 63]
                step, last[i] = block[0] - last[i], block[0]
                n = abs(step).bit_length()
                bits += dc[n] + (f"{step if step > 0 else step + (1 << n) - 1:0{n}b}" if n else "")
                zeros = 0
                for value in block[1:]:
                    if not value:
                        zeros += 1
                        continue
                    while zeros > 15:
                        bits, zeros = bits + ac[0xF0], zeros - 16
                    n = abs(value).bit_length()
                    bits += ac[zeros << 4 | n] + f"{value if value > 0 else value + (1 << n) - 1:0{n}b}"
                    zeros = 0
                if zeros:
                    bits += ac[0]
        bits += "1" * (-len(bits) % 8)
        out += bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")
        out += bytes([0xFF, 0xD0 + a // every % 8]) if a + every < len(units) else b"\xff\xd9"
    return out


def flat_table(symbols):
    """All codes 8 bits long but for the last, as no code may be all ones."""
    counts = [0] * 16
    counts[7], counts[8] = min(len(symbols), 255), max(len(symbols) - 255, 0)
    return tuple(counts), tuple(symbols)


def plain_hash(pixels):
    """Which cells of an 8 by 8 grid are brighter than the mean."""
    down, across = len(pixels), len(pixels[0])
    cut = lambda i, n: (min(i * n // 8, n - 1), max(min((i + 1) * n // 8, n - 1), min(i * n // 8, n - 1) + 1))
    total, bits = sum(map(sum, pixels)), ""
    for y in range(8):
        for x in range(8):
            (r0, r1), (c0, c1) = cut(y, down), cut(x, across)
            cell = [v for row in pixels[r0:r1] for v in row[c0:c1]]
            bits += str(int(sum(cell) * down * across > total * len(cell)))
    return f"{int(bits, 2):016x}"


@pytest.mark.parametrize("restart", [0, 3])
def test_files_of_another_encoder(restart):
    """Three components, a luminance of 2 by 2 blocks, 16-bit quantisation, runs of zeros, ends of blocks, with and without intervals."""
    rng = random.Random(restart)
    dc = flat_table(range(12))
    ac = flat_table([0, 0xF0, *(r << 4 | n for r in range(16) for n in range(1, 11))])
    other = (flat_table(range(11, -1, -1)), flat_table([*(r << 4 | n for r in range(15, -1, -1) for n in range(10, 0, -1)), 0xF0, 0]))

    def block():
        values = [rng.randint(-900, 900), *[0] * 63]
        for k in rng.sample(range(1, 64), rng.choice([0, 1, 2, 5, 63])):
            values[k] = rng.choice([-1023, -2, -1, 1, 2, 700])
        return values

    width, height = 70, 41  # 5 by 3 units of 16 by 16
    units = [[block() for _ in range(6)] for _ in range(15)]
    raw = plain_file(width, height, [(2, 2, 0), (1, 1, 1), (1, 1, 1)], units, [(dc, ac), other], restart, wide=True)
    image = parse(raw)
    assert (image.width, image.height, len(image.components)) == (width, height, 3)
    assert decode_scans([image])[0].tolist() == [b for unit in units for b in unit]
    want = [
        [min(max((units[y // 2 * 5 + x // 2][y % 2 * 2 + x % 2][0] * 300 + 4) // 8 + 128, 0), 255) for x in range(9)]
        for y in range(6)
    ]
    found = read_images([raw, write_images([b"x" * 64])[0]])
    assert (found[0].error, found[0].payload, found[0].width, found[0].height) == (None, None, width, height)
    assert np.frombuffer(found[0].thumbnail, np.uint8).reshape(6, 9).tolist() == want
    assert found[0].thumbnail_hash == plain_hash(want)
    assert found[1].payload == b"x" * 64


def plain_row(text):
    """What the query says of a text, by the plain coder."""
    raw = (text or "").encode()
    payload = raw + bytes(-len(raw) % 64 if raw else 64)
    blocks = [[b - 128 + (b >= 128) for b in payload[a : a + 64]] for a in range(0, len(payload), 64)]
    wide = next(w for w in range(1, len(blocks) + 1) if w * w >= len(blocks))
    high = -(-len(blocks) // wide)
    terms = [b[0] for b in blocks] + [0] * (wide * high - len(blocks))
    pixels = [[min(max((t + 4) // 8 + 128, 0), 255) for t in terms[y * wide : (y + 1) * wide]] for y in range(high)]
    units = [[b] for b in blocks] + [[None]] * (wide * high - len(blocks))
    media = plain_file(
        wide * 8, high * 8, [(1, 1, 0)], units, [(media_jpeg.DC_TABLE, media_jpeg.AC_TABLE)], media_jpeg.INTERVAL, media_jpeg.COMMENT + str(len(payload)).encode()
    )
    return (
        len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]),
        len(media), hashlib.sha256(media).hexdigest(), f"{wide * 8}x{high * 8}:{plain_hash(pixels)}",
    )


def test_the_query_gives_the_plain_rows(spark, docs, odd_rows, tmp_path):
    """All columns of all rows."""
    rng = random.Random(4)
    rows = [*odd_rows, *((1000 + i, "".join(rng.choice("ab \u00e9\u4e2d\U0001f600") for _ in range(n)), "s", "en") for i, n in enumerate([1, 63, 64, 65, 257, 3000]))]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in QUERIES["op2_media"](spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == sorted(((key, *plain_row(text)) for key, text, *_ in rows), key=repr)


def test_pieces_do_not_show(monkeypatch):
    rng = random.Random(7)
    payloads = [rng.randbytes(64 * n) for n in (1, 5, 300, 2, 40)]
    whole = write_images(payloads)
    monkeypatch.setattr(media_jpeg, "LANES", 3)
    assert write_images(payloads) == whole
    assert [m.payload for m in read_images(whole)] == payloads
