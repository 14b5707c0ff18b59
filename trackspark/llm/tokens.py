"""Hashes of words from Arrow text columns, whole batches at a time.

Used inside tasks by the operators that need every word of every text. A word is a run of bytes other than
ASCII white space, with A-Z in lower case. Its hash is a polynomial over random byte values modulo
2^64, taken from prefix sums, then mixed. Texts are read in slabs that end between words, so that memory
stays small however long a text is.
"""

import numpy as np

SLAB = 1 << 20
SLICE = 2 << 20
_random = np.random.Generator(np.random.PCG64(20240229))
_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[ord("A"):ord("Z") + 1] = _VALUES[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_powers = {}


def _power(base, n):
    """1, base, base^2, ... modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLAB + 4096), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def mix(x):
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column):
    """(bytes, offsets) of an Arrow string column; a null text is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch, column="text", limit=SLICE):
    """Parts of an Arrow batch with about ``limit`` bytes of text each, or one text where it is longer.

    What a task computes from a part is freed with it, and memory that Arrow keeps for reuse is given back after the batch.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")), at + 1)
        yield batch.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()


def _slab(data, breaks):
    """Hashes and start places of the words in ``data``; a word also ends at each place in ``breaks``."""
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = breaks[inside[breaks]] if len(breaks) else breaks
    first[cut] = True
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = cut[cut > 0] - 1
    last[cut[inside[cut]]] = True
    ends = np.flatnonzero(last) + 1
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * _power(_BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64)), starts


def word_hashes(column):
    """(hashes, bounds): the word hashes of all texts of a column, and where each text's words begin and end."""
    data, offsets = text_bytes(column)
    hashes, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    at = 0
    while at < len(data):
        end = min(at + SLAB, len(data))
        while end < len(data) and _WORD[data[end]] and _WORD[data[end - 1]]:
            gap = np.flatnonzero(~_WORD[data[end:end + SLAB]])
            end = end + int(gap[0]) if len(gap) else min(end + SLAB, len(data))
        inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        found, begin = _slab(data[at:end], inner)
        hashes.append(found)
        starts.append(begin + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(column, size):
    """For each text its sorted distinct hashes of ``size`` words in a row; of all words where they are fewer."""
    words, bounds = word_hashes(column)
    odd = _power(0xD1342543DE82EF95, size + 1)[1:]
    n = max(len(words) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled += words[k:k + n] * odd[k]
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            yield np.unique(rolled[a:b - size + 1])
        elif b > a:
            part = words[a:b]
            yield mix((part * odd[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield part_of_nothing


part_of_nothing = np.empty(0, np.uint64)
