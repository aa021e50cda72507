"""Periodic runs of words, found by string synchronising sets.

All texts of a block are one sequence of word hashes with a one-off mark after each text,
so that nothing repeats across texts.

1. For every scale s = 4, 8, 16, ... a hash of each window of s words picks the
   synchronising positions: i is one if the least hash among the windows at i .. i + s is
   that at i or at i + s. The choice depends on the 2 s words from i alone, so equal
   contexts choose alike. Windows of period s / 4 or less are left out.
2. A run of period q, s <= q < 2 s, of four periods or more holds two such positions q
   apart with equal contexts of 2 s words, the second the next one after the first: equal
   neighbours propose a period. (Were there none in the first 3 q words, all of them would
   have a period of s / 4 or less, and with it the root of the run would be a power.)
3. Periods below the smallest scale, and the windows left out, come from runs found
   before: periods 1 to 3 by direct comparison, longer ones at the scales below.
4. Every proposal is stretched word by word to its maximal run.

The work is proportional to the words for each scale, with log2(n / 4) scales.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import ship_package

LEAST_PERIODS = 4
LEAST_WORDS = 6
FIRST_SCALE = 4
RUN_TYPE = "array<struct<start: long, length: long, period: long>>"
_NEVER = A.U(0xFFFFFFFFFFFFFFFF)
_WEIGHTS = A.odd_numbers(2, 43)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring windows; not linear, so that no pattern cancels."""
    return A.mixed(A.mixed(left * _WEIGHTS[0]) + right * _WEIGHTS[1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every window of ``width`` values."""
    out, held = values, 1
    while 2 * held <= width:
        out = np.minimum(out[:-held], out[held:])
        held *= 2
    rest = width - held
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _direct(words: np.ndarray, period: int) -> np.ndarray:
    """(start, end) of the runs of one small period, LEAST_PERIODS periods at least."""
    same = np.zeros(max(len(words) - period, 0) + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:] if len(words) > period else 0
    edges = np.diff(same)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= (LEAST_PERIODS - 1) * period
    return np.stack([starts[long], ends[long] + period], axis=1)


def _stretched(words: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The maximal run of ``period`` around words[start:end], which has this period."""
    step = 64
    while end < len(words):
        stop = min(end + step, len(words))
        differ = np.flatnonzero(words[end:stop] != words[end - period : stop - period])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, 2 * step
    step = 64
    while start > 0:
        stop = max(start - step, 0)
        differ = np.flatnonzero(words[stop:start] != words[stop + period : start + period])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end


def _synchronising(windows: np.ndarray, scale: int, runs: np.ndarray) -> np.ndarray:
    """Synchronising positions of a scale; ``runs`` are those found at smaller scales."""
    if len(windows) <= scale:
        return np.zeros(0, np.int64)
    low = runs[(4 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    ranks = windows
    if len(low):
        depth = np.zeros(len(windows) + 1, np.int64)
        np.add.at(depth, low[:, 0], 1)
        np.add.at(depth, low[:, 1] - scale + 1, -1)
        ranks = np.where(np.cumsum(depth[:-1]) > 0, _NEVER, windows)
    least = _least(ranks, scale + 1)
    picked = (ranks[: len(least)] == least) | (ranks[scale:] == least)
    return np.flatnonzero(picked & (least != _NEVER))


def _proposed(words: np.ndarray, at: np.ndarray, contexts: np.ndarray, scale: int) -> np.ndarray:
    """Runs (start, end, period) around equal contexts that follow each other."""
    order = np.argsort(contexts, kind="stable")
    same = contexts[order][1:] == contexts[order][:-1]
    first, period = at[order][:-1][same], np.diff(at[order])[same]
    fits = (period >= scale) & (period < 2 * scale)
    first, period = first[fits], period[fits]
    order = np.lexsort((first, period))
    first, period = first[order], period[order]
    # spans of one period that overlap by a period or more are one run
    fresh = np.ones(len(first) + 1, bool)
    fresh[1:-1] = (period[1:] != period[:-1]) | (np.diff(first) > 2 * scale)
    found, done = [], (0, 0, 0)
    heads = np.flatnonzero(fresh)
    for a, b in zip(heads[:-1], heads[1:]):
        q = int(period[a])
        start, end = int(first[a]), int(first[b - 1]) + q + 2 * scale
        if done[2] == q and end <= done[1]:
            continue
        done = (*_stretched(words, start, end, q), q)
        if done[1] - done[0] >= LEAST_PERIODS * q:
            found.append(done)
    return np.array(sorted(set(found)), np.int64).reshape(-1, 3)


def _without_powers(runs: np.ndarray) -> np.ndarray:
    """Of runs over the same words the one with the smallest period."""
    order = np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))
    runs = runs[order]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[fresh]


def find_runs(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(row, start, length, period) of all runs of rows of word hashes.

    Row r has the words first[r] to first[r + 1]. A run is a maximal stretch whose
    smallest period q fits LEAST_PERIODS times; at least LEAST_WORDS long. Ordered by
    row, start and period.
    """
    rows, counts = len(first) - 1, np.diff(first)
    total = len(hashes) + rows
    if not len(hashes):
        return np.zeros((0, 4), np.int64)
    words = np.empty(total, np.uint64)
    begins = first[:-1] + np.arange(rows)  # every row is followed by its one-off mark
    inside = np.ones(total, bool)
    inside[begins + counts] = False
    words[inside] = hashes
    words[~inside] = A.mixed(np.arange(rows, dtype=np.uint64) + A.U(1 << 63))
    runs = np.concatenate(
        [np.zeros((0, 3), np.int64)]
        + [
            np.column_stack([found, np.full(len(found), q)])
            for q in range(1, FIRST_SCALE)
            if len(found := _direct(words, q))
        ]
    )
    runs = _without_powers(runs)
    scale, windows, kept = FIRST_SCALE, _joined(words[:-1], words[1:]), np.arange(total)
    windows = _joined(windows[:-2], windows[2:]) if len(windows) > 2 else windows[:0]
    while scale * LEAST_PERIODS <= counts.max():
        # only rows that have room for a run of this scale go on
        large = np.flatnonzero(counts >= scale * LEAST_PERIODS)
        mine = np.zeros(total + 1, np.int64)
        mine[begins[large]] += 1
        mine[begins[large] + counts[large] + 1] -= 1
        stay = (np.cumsum(mine[:-1]) > 0)[kept]
        windows, kept = windows[stay[: len(windows)]], kept[stay]
        local = words[kept]
        places = np.full(total + 1, -1, np.int64)
        places[kept] = np.arange(len(kept))
        held = runs[places[runs[:, 0]] >= 0]
        shifted = held.copy()
        shifted[:, 0] = places[held[:, 0]]
        shifted[:, 1] = shifted[:, 0] + held[:, 1] - held[:, 0]
        double = _joined(windows[:-scale], windows[scale:]) if len(windows) > scale else windows[:0]
        at = _synchronising(windows, scale, shifted)
        at = at[at < len(double)]
        found = _proposed(local, at, double[at], scale)
        if len(found):
            back = found.copy()
            back[:, 0] = kept[found[:, 0]]
            back[:, 1] = back[:, 0] + found[:, 1] - found[:, 0]
            runs = _without_powers(np.concatenate([runs, back]))
        windows, scale = double, 2 * scale
    runs = runs[runs[:, 1] - runs[:, 0] >= LEAST_WORDS]
    row = np.searchsorted(begins, runs[:, 0], "right") - 1
    out = np.column_stack([row, runs[:, 0] - begins[row], runs[:, 1] - runs[:, 0], runs[:, 2]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def kept_words(first: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those that no run holds behind its first period."""
    depth = np.zeros(int(first[-1]) + 1, np.int64)
    starts = first[runs[:, 0]] + runs[:, 1]
    np.add.at(depth, starts + runs[:, 3], 1)
    np.add.at(depth, starts + runs[:, 2], -1)
    return np.cumsum(depth[:-1]) == 0


def _collapsed(data, starts, ends, first, kept) -> pa.Array:
    """Texts of the kept words of every row, joined by one space."""
    counts = A.row_sums(kept.astype(np.int64), first)
    starts, ends = starts[kept], ends[kept]
    spaced = np.concatenate([data, np.array([32], np.uint8)])
    lengths = ends - starts + 1  # a space behind each word
    last = np.cumsum(counts)[counts > 0] - 1
    lengths[last] -= 1
    begins = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), np.uint8)
    # in parts, as places of bytes need eight times their room
    a = 0
    while a < len(starts):
        b = min(max(int(np.searchsorted(begins, begins[a] + A.CHUNK)), a + 1), len(starts))
        size = lengths[a:b]
        place = np.arange(int(size.sum())) + np.repeat(starts[a:b] - (begins[a:b] - begins[a]), size)
        behind = place == np.repeat(ends[a:b], size)
        place[behind] = len(data)
        out[begins[a] : begins[a] + len(place)] = spaced[place]
        a = b
    ends_of_rows = np.concatenate([[0], np.cumsum(A.row_sums(lengths, np.concatenate([[0], np.cumsum(counts)])))])
    return pa.LargeStringArray.from_buffers(
        len(counts), pa.py_buffer(ends_of_rows.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())
    ).cast(pa.string())


def _run_lists(runs: np.ndarray, rows: int) -> pa.Array:
    at = np.searchsorted(runs[:, 0], np.arange(rows + 1)).astype(np.int32)
    fields = [pa.array(runs[:, k]) for k in (1, 2, 3)]
    return pa.ListArray.from_arrays(
        pa.array(at), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    )


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, offsets = A.text_bytes(whole.column("text"))
        for a, b in A.row_blocks(offsets, A.CHUNK):
            batch = whole.slice(a, b - a)
            data, offsets = A.text_bytes(batch.column("text"))
            starts, ends, first = A.word_spans(data, offsets, A.SPACED)
            runs = find_runs(A.span_hashes(data, starts, ends), first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(first)),
                    _run_lists(runs, len(first) - 1),
                    _collapsed(data, starts, ends, first, kept_words(first, runs)),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Periodic runs of every text, and the text with one period left of each.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, case counts. A run is a maximal stretch of
    words with smallest period q (words q apart are equal) of at least max(6, 4 q) words.

    Returns (doc_id, n_words, runs, collapsed), one row per row of ``docs``; ``runs`` by
    start, then period; ``collapsed`` has all words but those that a run holds behind its
    first q words, joined by one space. Null, empty and blank texts have no words, no runs
    and an empty ``collapsed``. Other columns are ignored. A task holds one text at a time
    beyond a megabyte, with about 60 bytes for each of its words.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = T.StructType(
        [
            T.StructField("doc_id", own.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T._parse_datatype_string(RUN_TYPE)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return own.mapInArrow(_find, out)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest length / period, compared exactly; the earliest of equals."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.reduce(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run.length * best.period > best.length * run.period, run).otherwise(best),
    )


def with_planted_period(text: Column, doc_id: Column) -> Column:
    """Texts of every tenth document by hash with a period from some word on.

    With h the crc32 of the id as text and g = floor(h / 10): if h % 10 = 0, every word
    i >= a = g % n becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    Other texts, also those of a null id, stay as they are; null is the empty text.
    """
    text = F.coalesce(text, F.lit(""))
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    # whole arrays: a lambda would split the text again for every word
    periods = F.ceil((n - a) / p).cast("int")
    rest = F.flatten(F.array_repeat(F.slice(words, a + 1, p), periods))
    edited = F.slice(F.concat(F.slice(words, F.lit(1), a), rest), F.lit(1), n)
    return F.when(h % 10 == 0, F.array_join(edited, " ")).otherwise(text)
