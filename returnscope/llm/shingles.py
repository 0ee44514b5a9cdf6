"""Shingle sets, one-permutation signatures and set overlap for many texts at once.

Works on the bytes of Arrow string columns. Hashes are prefix sums of a polynomial modulo 2**64 over
random byte codes, so that the hash of any stretch of bytes is a difference of two sums; they depend
on nothing but the text. Inside a chunk, a text's number and a shingle's hash share one 64-bit key:
one sort yields the distinct shingles of all texts, in which the smallest hash of every bin comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TEXT_BITS = 12  # at most 4,095 texts a chunk
HASH_BITS = 64 - TEXT_BITS
HASH_MASK = np.uint64((1 << HASH_BITS) - 1)
CHUNK_BYTES = 1 << 16  # so that a chunk's arrays stay in a core's cache
_STEP = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_STEP, -1, 1 << 64)
_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x *= np.uint64(factor)
        x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n).bit_length())
    if size not in _powers:
        tables = []
        for base in (_STEP, _INVERSE):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > 1 << 22:  # for one very long text; not kept
            return tables[0], tables[1]
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of rows; nulls are empty. A longer text is a chunk of its own."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + max_bytes, side="right")) - 1
        stop = min(max(stop, row + 1), n, row + (1 << TEXT_BITS) - 1)
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    powers, inverse = _power_tables(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_CODES[codes] * powers[: len(codes)], out=total[1:])
    return total, inverse


def word_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle of ``k`` words, A-Z in lower case.

    A text of fewer words, but not none, has the whole sequence as its one shingle.
    """
    low = _LOWER[data]
    word = ~_SPACE[low]
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.concatenate((word[1:], [False])) if len(word) else word
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total, inverse = _sums(low)
    words = mix((total[ends] - total[starts]) * inverse[starts])
    texts = np.searchsorted(offsets, starts, side="right") - 1
    length = np.bincount(texts, minlength=len(offsets) - 1)
    left = np.cumsum(length)[texts] - np.arange(len(words))  # words from here to the end of the text
    out = np.zeros(len(words), np.uint64)
    factor = 1
    for j in range(k):
        shifted = np.zeros(len(words), np.uint64)
        shifted[: max(0, len(words) - j)] = words[j:]
        out += np.where(left > j, shifted, np.uint64(0)) * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    whole = (left >= k) | ((length[texts] < k) & (left == length[texts]))
    return texts[whole], mix(out[whole] + np.uint64(k))


def char_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every shingle of ``k`` bytes' worth of characters.

    Shingles start at characters and take ``k`` characters; a shorter text is one shingle.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    edge = np.searchsorted(starts, offsets)
    length = np.diff(edge)
    count = np.where(length < k, length > 0, length - k + 1)
    texts = np.repeat(np.arange(len(length)), count)
    first = np.arange(len(texts)) + np.repeat(edge[:-1] - np.cumsum(count) + count, count)
    bounds = np.append(starts, len(data))
    ends = bounds[np.minimum(first + k, np.repeat(edge[1:], count))]
    starts = starts[first]
    total, inverse = _sums(data)
    return texts, mix((total[ends] - total[starts]) * inverse[starts])


SHINGLERS = {"words": word_shingles, "chars": char_shingles}


def distinct(texts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct keys: text number above, hash below."""
    keys = (texts.astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes & HASH_MASK)
    keys.sort()
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys


def set_digests(keys: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each text's set and two order-free 64-bit digests of it."""
    owner = (keys >> np.uint64(HASH_BITS)).astype(np.int64)
    size = np.bincount(owner, minlength=n_texts)
    values = keys & HASH_MASK
    edge = np.concatenate(([0], np.cumsum(size)))
    spread = mix(values ^ np.uint64(0xA0761D6478BD642F))
    digests = []
    for terms in (spread, spread * (spread >> np.uint64(32))):
        running = np.zeros(len(keys) + 1, np.uint64)
        np.cumsum(terms, out=running[1:])
        digests.append((running[edge[1:]] - running[edge[:-1]]).view(np.int64))
    return size, digests[0], digests[1]


def signatures(keys: np.ndarray, n_texts: int, bins: int) -> np.ndarray:
    """One-permutation signatures with optimal densification; a text without shingles has a row of zeros.

    A bin is the leading bits of a hash and keeps its smallest one. An empty bin asks other bins in
    an order that depends on the bin and the attempt only, until one is filled: equal sets and the
    shared part of similar ones fill it alike.
    """
    bits = bins.bit_length() - 1
    cell = (keys >> np.uint64(HASH_BITS - bits)).view(np.int64)  # text number and bin
    lead = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    cell = cell[lead]
    table = np.zeros((n_texts, bins), np.uint64)
    filled = np.zeros((n_texts, bins), bool)
    table.reshape(-1)[cell] = keys[lead] & HASH_MASK
    filled.reshape(-1)[cell] = True
    rows, columns = np.nonzero(~filled & filled.any(axis=1)[:, None])
    out, attempt = table.copy(), 1
    while len(rows):
        asked = mix(np.arange(bins, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(attempt)) % np.uint64(bins)
        donor = asked.astype(np.int64)[columns]
        has = filled[rows, donor]
        out[rows[has], columns[has]] = table[rows[has], donor[has]]
        rows, columns = rows[~has], columns[~has]
        attempt += 1
    return out


def band_hashes(table: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash of every ``rows`` neighbouring bins, which also depends on the band."""
    n, bins = table.shape
    parts = mix(table + np.uint64(1)).reshape(n, bins // rows, rows)
    factors = np.array([pow(0xD6E8FEB86659FD93, j, 1 << 64) for j in range(rows)], np.uint64)
    band = np.arange(bins // rows, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
    return mix((parts * factors).sum(axis=2, dtype=np.uint64) + band).view(np.int64)


def overlaps(left: pa.Array, right: pa.Array, kind: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of the shingle sets, row by row, with 64-bit hashes."""
    shingler = SHINGLERS[kind]
    n = len(left)
    sizes = np.zeros((2, n), np.int64)
    common = np.zeros(n, np.int64)
    lengths = sum(pc.binary_length(column).fill_null(0).to_numpy().astype(np.int64) for column in (left, right))
    row = 0
    while row < n:
        stop = row + max(1, int(np.searchsorted(np.cumsum(lengths[row : row + 2000]), CHUNK_BYTES, side="right")))
        stop = min(stop, n, row + 2000)
        keys = []
        for side, column in enumerate((left, right)):
            piece = column.slice(row, stop - row).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(piece.buffers()[1], dtype=np.int64)[piece.offset : piece.offset + len(piece) + 1]
            data = np.frombuffer(piece.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
            texts, hashes = shingler(data, offsets - offsets[0], k)
            order = np.lexsort((hashes, texts))
            texts, hashes = texts[order], hashes[order]
            fresh = np.ones(len(texts), bool)
            fresh[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
            texts, hashes = texts[fresh], hashes[fresh]
            sizes[side, row:stop] = np.bincount(texts, minlength=stop - row)
            keys.append((texts, hashes))
        texts = np.concatenate((keys[0][0], keys[1][0]))
        hashes = np.concatenate((keys[0][1], keys[1][1]))
        order = np.lexsort((hashes, texts))
        texts, hashes = texts[order], hashes[order]
        twice = (texts[1:] == texts[:-1]) & (hashes[1:] == hashes[:-1])
        common[row:stop] = np.bincount(texts[1:][twice], minlength=stop - row)
        row = stop
    return common, sizes[0] + sizes[1] - common
