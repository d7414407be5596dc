"""Word shingles and HyperMinHash registers of Arrow text columns, in numpy.

A shingle is hashed to 64 bits.  The leading bits choose a bucket; of the rest
the smallest value in the bucket counts, and a register stores it compressed:
the number of its leading zeros (6 bits) and the mantissa bits that follow
(10 bits).  Empty buckets borrow the register of a bucket that a fixed hash
sequence names, so that short texts have full sketches too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Registers of a sketch are 2**BUCKET_BITS.
BUCKET_BITS = 9
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
#: Odd multipliers that mix the words of a shingle by place (fixed values).
PLACES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * PLACES[1]
    x = (x ^ (x >> np.uint64(27))) * PLACES[2]
    return x ^ (x >> np.uint64(31))


#: A random number for each place in a word (modulo 64) and byte there.
LETTERS = mix(np.arange(64 * 256, dtype=np.uint64) * PLACES[0] + PLACES[4])
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def hash_words(texts: pa.Array, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and each text's number of words.

    Words lie between runs of space and controls 9 to 13; A to Z count as a to
    z.  A word's hash is the sum of its letters' random numbers, mixed.  The
    letters are walked in chunks that end with a word, so the memory beyond the
    texts and their hashes doesn't grow with them.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    hashed, counts, a = [], np.zeros(len(texts), np.int64), 0
    while a < len(data):
        b = min(a + chunk, len(data))
        while b < len(data):
            # The border of a text or of a word that comes next.
            near = np.flatnonzero(WHITE[data[b : b + chunk]])
            stop = int(offsets[np.searchsorted(offsets, b)])
            border = min(b + int(near[0]) if len(near) else b + chunk, stop)
            if border < b + chunk or border == stop:
                b = border
                break
            b = border
        at = np.searchsorted(offsets, a, "right") - 1, np.searchsorted(offsets, b)
        inner = np.clip(offsets[at[0] : at[1] + 1] - a, 0, b - a)
        some, n = _hash_letters(LOWER[data[a:b]], inner)
        hashed.append(some)
        counts[at[0] : at[1]] += n
        a = b
    return (np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)), counts


def _hash_letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[1:-1][offsets[1:-1] < len(data)]
    first[borders] = inside[borders]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    counts = np.diff(np.searchsorted(starts, offsets))
    begin = np.r_[np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(starts, append=len(data)))]
    place = np.arange(len(data)) - begin
    value = LETTERS[(place & 63) << 8 | data]
    far = place > 63
    if far.any():
        value[far] = mix(value[far] + (place[far] >> 6).astype(np.uint64))
    value[~inside] = 0
    return mix(np.add.reduceat(value, starts)), counts


@dataclass
class ShingleSets:
    """Sets of hashes of consecutive texts: ascending within a text, without repeats."""

    hashes: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def shingle_sets(texts: pa.Array, width: int = 5) -> ShingleSets:
    """The distinct ``width``-word shingles of each text.

    With fewer words the whole sequence is one shingle (its number of words is
    part of the hash); without words the set is empty.
    """
    hashed, counts = hash_words(texts)
    firsts = np.cumsum(counts) - counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    at = firsts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    span = np.minimum(counts, width)[owner]
    out = span.astype(np.uint64) * PLACES[7]
    for k in range(width):
        inside = k < span
        if inside.all():
            out += mix(hashed[at + k] + PLACES[k % 7]) * PLACES[(k + 3) % 7]
        else:
            out[inside] += mix(hashed[at[inside] + k] + PLACES[k % 7]) * PLACES[(k + 3) % 7]
        out = mix(out + np.uint64(k))
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return ShingleSets(out[new], np.bincount(owner[new], minlength=len(counts)))


def _sequence(tries: int) -> np.ndarray:
    place = np.arange(REGISTERS, dtype=np.uint64)[:, None] * PLACES[3] + np.arange(tries, dtype=np.uint64)[None, :] * PLACES[4]
    return mix(place)


#: For each bucket some buckets to borrow from in turn, and an order of all buckets, the same for all texts.
DONORS = (_sequence(64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
ORDER = _sequence(REGISTERS).argsort(1).argsort(1).astype(np.int32)


def sketches(sets: ShingleSets) -> np.ndarray:
    """Registers (texts by REGISTERS, 16 bits each); rows of empty sets are all ones."""
    n = len(sets.sizes)
    out = np.full((n, REGISTERS), 0xFFFF, np.uint16)
    if not len(sets.hashes):
        return out
    owner = np.repeat(np.arange(n), sets.sizes)
    bucket = (sets.hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    cell = owner * REGISTERS + bucket
    # Hashes ascend within a text, so the first in a bucket is its smallest.
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    rest = sets.hashes[first] << np.uint64(BUCKET_BITS)
    top = (rest >> np.uint64(11)).astype(np.float64)  # 53 bits are exact
    zeros = np.where(top > 0, 53 - np.frexp(top)[1], 53).astype(np.uint64)
    after = (rest << np.minimum(zeros + np.uint64(1), np.uint64(63))) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[cell[first]] = ((zeros << np.uint64(MANTISSA)) | after).astype(np.uint16)
    filled = np.zeros((n, REGISTERS), bool)
    filled.reshape(-1)[cell[first]] = True
    rows, columns = np.nonzero(~filled & (sets.sizes > 0)[:, None])
    for k in range(DONORS.shape[1]):
        if not len(rows):
            break
        donor = DONORS[columns, k]
        found = filled[rows, donor]
        out[rows[found], columns[found]] = out[rows[found], donor[found]]
        rows, columns = rows[~found], columns[~found]
    # Few buckets are full: the one that comes first in the column's order lends.
    for some in np.split(np.arange(len(rows)), range(8192, len(rows), 8192)):
        if len(some):
            place = np.where(filled[rows[some]], ORDER[columns[some]], REGISTERS)
            out[rows[some], columns[some]] = out[rows[some], place.argmin(1)]
    return out


def chance_matches(sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """The share of registers that agree although their smallest shingles differ.

    Two different minima agree if they fall into one cell of the compressed
    scale.  Minima of n values in a bucket are about exponential with rate n, so
    a cell of relative width 2**-MANTISSA around x has both with probability
    proportional to the product of the two densities; summed over all cells
    that is 2**-MANTISSA * a * b / (a + b)**2 up to a factor below 1.5.
    """
    a, b = np.maximum(sizes_a, 1).astype(np.float64), np.maximum(sizes_b, 1).astype(np.float64)
    return 1.4 * 2.0**-MANTISSA * a * b / (a + b) ** 2


def estimated_jaccard(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Estimates for rows of registers, corrected for chance matches."""
    equal = (a == b).mean(-1)
    chance = chance_matches(sizes_a, sizes_b)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def band_keys(registers: np.ndarray, rows_in_band: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows_in_band`` registers (texts by bands); the band is part of it."""
    bands = registers.shape[1] // rows_in_band
    words = np.ascontiguousarray(registers[:, : bands * rows_in_band]).astype(np.uint64).reshape(len(registers), bands, rows_in_band)
    key = np.arange(bands, dtype=np.uint64)[None, :] * PLACES[5] + PLACES[6]
    for k in range(rows_in_band):
        key = mix(key ^ (words[:, :, k] * PLACES[k % 8]))
    return key.view(np.int64)
