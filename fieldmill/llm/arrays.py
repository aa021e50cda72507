"""Texts of an Arrow column as numpy arrays: words, hashes and sums per row.

Everything works on whole texts. Temporary arrays are cut at about a megabyte of
text, so that a very long text needs little more memory than its own bytes and
one hash for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_STEP = 1 << 16
U = np.uint64


def odd_numbers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers, the same everywhere."""
    draws = np.random.Generator(np.random.PCG64(seed))
    return draws.integers(0, 2**64, count, dtype=np.uint64) | U(1)


_PLACE = odd_numbers(_STEP, 11)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    out = values ^ (values >> U(33))
    out *= U(0xFF51AFD7ED558CCD)
    out ^= out >> U(33)
    out *= U(0xC4CEB9FE1A85EC53)
    out ^= out >> U(33)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of the rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_blocks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` items, at least one row each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray):
    """Starts and ends of maximal runs of bytes of one kind (0: between runs).

    ``kinds`` gives the kind of each of the 256 byte values; flags serve as well.
    Returns (starts, ends, first): row r has the words first[r] to first[r + 1].
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    kind = kinds[data]
    inside = kind > 0
    change = np.ones(len(data) + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offsets] = True
    starts = np.flatnonzero(inside & change[:-1])
    return starts, np.flatnonzero(inside & change[1:]) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash of the bytes (or code points) of each span, in order."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = int(np.searchsorted(ends, starts[at] + CHUNK, "right"))
        stop = min(max(stop, at + 1), len(starts))
        lengths = ends[at:stop] - starts[at:stop]
        begins = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
        picked = data[place + np.repeat(starts[at:stop], lengths)].astype(np.uint64) + U(1)
        if lengths.max() > _STEP:
            picked += (place >> 16).astype(np.uint64) << U(32)
        picked *= _PLACE[place & (_STEP - 1)]
        out[at:stop] = np.add.reduceat(picked, begins) + lengths.astype(np.uint64)
        at = stop
    return mixed(out)


def run_hashes(hashes: np.ndarray, first: np.ndarray, width: int):
    """Hashes of ``width`` consecutive words; a row with fewer words is one run.

    Returns (run hashes, first): row r has the runs first[r] to first[r + 1].
    """
    weights = odd_numbers(width, 23)
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    ends = np.cumsum(runs)
    begins = ends - runs
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    if len(hashes) >= width:
        body = hashes[: len(hashes) - width + 1] * weights[0]
        for k in range(1, width):
            body += hashes[k : len(hashes) - width + 1 + k] * weights[k]
        full = counts >= width
        source = np.repeat(first[:-1][full] - begins[full], runs[full])
        where = np.repeat(full, runs)
        out[where] = body[source + np.flatnonzero(where)]
    for row in np.flatnonzero((counts > 0) & (counts < width)):
        words = hashes[first[row] : first[row + 1]]
        out[begins[row]] = (words * weights[: len(words)]).sum(dtype=np.uint64) + U(len(words))
    return mixed(out), np.concatenate([[0], ends]).astype(np.int64)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the items of each row along axis 0; a row without items gives 0."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, first[full], axis=0)
    return out


def byte_flags(pattern: str) -> np.ndarray:
    """Which byte values a bytes pattern of one character matches."""
    import re

    rule = re.compile(pattern.encode("ascii"))
    return np.array([rule.fullmatch(bytes([b])) is not None for b in range(256)])


def word_and_symbol_kinds() -> np.ndarray:
    """Kind 1: letters, digits and all non-ASCII bytes; kind 2: ASCII symbols."""
    word, symbol = byte_flags(r"[0-9A-Za-z]"), byte_flags(r"[!-/:-@\[-`{-~]")
    out = np.where(word, 1, np.where(symbol, 2, 0)).astype(np.uint8)
    out[128:] = 1
    return out


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SPACED = byte_flags(r"[^\x20\x09-\x0D]")


def with_text(batches: Iterator[pa.RecordBatch], place: int | None) -> Iterator[pa.RecordBatch]:
    """Batches with a ``text`` column, taken from field ``place`` of whole carried rows."""
    for batch in batches:
        if place is not None:
            rows = batch.column("carried")
            batch = pa.RecordBatch.from_arrays([rows, rows.field(place)], ["carried", "text"])
        yield batch
