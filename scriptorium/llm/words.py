"""Words of many texts at once: byte arrays of Arrow columns to word and n-gram hashes.

A word is a longest run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased, that
is of ASCII digits, ASCII letters and everything beyond ASCII. In UTF-8 a byte is enough to tell.
Hashes are 64 bits wide and do not depend on the position in the column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


def mix(values):
    """Spread every bit of 64-bit values over all bits."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[LOWER]


def powers(base, n):
    out = np.full(n, base & _MASK, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = []


def _powers(n):
    """Powers of the base and of its inverse; those for a usual chunk are kept by a task's process."""
    if n < 4096 or n > CHUNK_BYTES + 4096:
        return powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
    if not _POWERS:
        _POWERS.extend(powers(b, CHUNK_BYTES + 4096) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _POWERS[0][:n], _POWERS[1][:n]


def word_spans(data, bounds):
    """Byte starts and ends of the words of texts that stand at ``bounds`` in a byte array."""
    inside = IS_WORD[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = np.asarray(bounds)
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_hashes(data, starts, ends):
    """A hash per word; long data are worked through piece by piece, cut between words."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    if len(data) > CHUNK_BYTES:
        cut = np.searchsorted(starts, np.arange(0, len(data), CHUNK_BYTES))
        cut = [*dict.fromkeys(cut.tolist()), len(starts)]
        return np.concatenate([
            _hashes(data[starts[a]:ends[b - 1]], starts[a:b] - starts[a], ends[a:b] - starts[a])
            for a, b in zip(cut, cut[1:]) if b > a])
    return _hashes(data, starts, ends)


def _hashes(data, starts, ends):
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ngram_hashes(hashes, n):
    """Hash of the ``n`` words from each word on; the last ``n - 1`` words have none."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:count] + np.uint64(n)
    for j in range(1, n):
        total = total * _STEP + hashes[j:j + count]
    return mix(total)


def column_bytes(column):
    """Offsets and bytes of an Arrow string column (null counts as empty)."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, data


def chunks(column):
    """Rows of a column in chunks of about ``CHUNK_BYTES``; a longer text is a chunk of its own.

    Yields (first row, last row + 1, bytes, text bounds in them, word starts, word ends, word hashes,
    first word of each text and the end of the last).
    """
    offsets, data = column_bytes(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        part, bounds = data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        starts, ends = word_spans(part, bounds)
        yield (row, end, part, bounds, starts, ends, word_hashes(part, starts, ends),
               np.searchsorted(starts, bounds))
        row = end


def words_of(data, starts, ends):
    """The words themselves, lower-cased, from byte spans."""
    low = LOWER[data].tobytes()
    return [low[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist())]


def signed(values):
    """Unsigned 64-bit values as Spark's bigint."""
    return np.ascontiguousarray(values, np.uint64).view(np.int64)
