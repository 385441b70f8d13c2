"""Vectorised text primitives over one Arrow batch of strings.

A batch is handled as one byte array with document offsets, so the cost per
document is a few numpy passes instead of Python calls. Hashes are
polynomial prefix hashes modulo 2**64 with odd multipliers, finished by a
bit mixer; keys that decide a result use two independent ones (128 bits).
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

U = np.uint64
BYTE_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

# ASCII space and the control characters 9 to 13 separate words.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n (kept per process)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, dtype=U)
        up[0] = 1
        down = np.full(size, pow(base, -1, 1 << 64), dtype=U)
        down[0] = 1
        have = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
        _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of values[i] * base**i, length n + 1."""
    up, _ = powers(base, len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[:-1], dtype=U, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] from prefix sums, equal for equal contents."""
    _, down = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values end to end and the n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_utf8())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64,
                            count=len(column) + 1, offset=column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: byte spans, first word of each document, hashes."""

    def __init__(self, column: pa.Array) -> None:
        self.raw, self.offsets = text_bytes(column)
        word = IS_WORD[self.raw]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        cuts = self.offsets[:-1][self.offsets[:-1] < len(word)]
        begin[cuts] = word[cuts]
        last = word.copy()
        last[:-1] &= ~word[1:]
        ends = self.offsets[1:] - 1
        ends = ends[ends >= 0]
        last[ends] = word[ends]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, self.offsets)  # n + 1 word indices
        self.count = np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        base = BYTE_BASES[which]
        return range_hash(prefix_hash(self.raw.astype(U), base), base, self.start, self.end)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost minimum, by the upper 32 bits, of every run of
    ``width`` values. The index rides in the lower bits, so each doubling of
    the reach is one vectorised minimum."""
    best = (values >> U(32) << U(32)) | np.arange(len(values), dtype=U)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[step:], best[:len(best) - step])
        reach += step
    return (best & U(0xFFFFFFFF)).astype(np.int64)


def owned_runs(hashes: np.ndarray, bounds: np.ndarray, width: int,
               part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Assign every window of ``width`` units to its anchor.

    ``hashes`` holds, for each start of a part of ``part`` units, a hash of
    units of that part; the anchor of a window is its leftmost minimal part,
    so equal windows have equal anchors at equal distances. ``bounds`` are the n + 1 unit
    offsets of the documents. Returns document, anchor, first and last
    window start of each run of windows with the same anchor.
    """
    none = np.zeros(0, np.int64)
    if len(hashes) < width - part + 1:
        return none, none, none, none
    at = sliding_argmin(hashes, width - part + 1)
    # windows may start up to `width` units before the end of their document
    inside = np.ones(len(at), dtype=bool)
    ends = bounds[1:]
    spare = np.maximum(ends - width + 1, bounds[:-1])
    out, _ = ranges(spare, ends - 1)
    inside[out[out < len(at)]] = False
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    doc = np.searchsorted(bounds, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(at)), spare[doc]) - 1
    return doc, at[first], first, last


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the inclusive ranges and the range each belongs to."""
    size = last - first + 1
    owner = np.repeat(np.arange(len(first)), size)
    begin = np.cumsum(size) - size
    return first[owner] + np.arange(len(owner)) - begin[owner], owner


def slices(table: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Pieces of a batch whose values of ``column`` hold about ``limit``
    bytes; one longer value is a piece of its own."""
    at = table.schema.get_field_index(column)
    _, offsets = text_bytes(table.column(at))
    row = 0
    while row < table.num_rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), table.num_rows)
        yield table.slice(row, stop - row)
        row = stop


def named_positions(lists: pa.Array, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of an Arrow list column of integers
    (null: empty), with ``base`` of its row added to the low 32 bits."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lists = lists.fill_null([])
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    value = lists.flatten().to_numpy(zero_copy_only=False)
    return base[row] + (value & 0xFFFFFFFF), value >> 32


def key_groups(batches, keys: list[str], least: int = 0, size_of: str | None = None):
    """Tables of whole key groups from batches sorted by ``keys``: one group
    each, or as many as hold ``least`` bytes, at 64 a row besides those of
    the column ``size_of``."""
    held: list[pa.RecordBatch] = []
    size, previous = 0, None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for n, c in enumerate(columns):
            new[1:] |= c[1:] != c[:-1]
            if previous is not None and batch.num_rows:
                new[0] |= bool(c[0] != previous[n])
        if batch.num_rows:
            previous = [c[-1] for c in columns]
        cut = 0
        lengths = None
        if size_of:
            offsets = np.frombuffer(batch.column(size_of).cast(pa.large_binary()).buffers()[1], np.int64,
                                    batch.num_rows + 1, batch.column(size_of).offset * 8)
            lengths = offsets - offsets[0] + 64 * np.arange(batch.num_rows + 1)
        for at in np.flatnonzero(new):
            more = int(lengths[at] - lengths[cut]) if lengths is not None else 0
            if size + more >= least:
                if at > cut:
                    held.append(batch.slice(cut, at - cut))
                if held:
                    yield pa.Table.from_batches(held)
                held, size, cut = [], 0, int(at)
        if batch.num_rows > cut:
            held.append(batch.slice(cut))
            if lengths is not None:
                size += int(lengths[-1] - lengths[cut])
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: the Python
    workers live on and share the executor with the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)
