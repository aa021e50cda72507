"""Best-fit packing of tokenised documents by minimum bin slack.

Tokens: byte-level BPE treats every pre-token by itself, so the texts are cut into
pre-tokens with numpy, each distinct pre-token of a block is encoded once by the
``tokenizers`` library, and ids are gathered back. A worker keeps a bounded table of
pre-tokens it has seen. Rows with characters whose class could differ between Unicode
versions are encoded whole by the library.

Packing: for each sequence the longest piece left is taken, and a subset-sum over the
available lengths (a bitset held in one integer) finds the fullest combination for the
rest. Pieces are dealt to tasks by a hash and packed in blocks of fixed size.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import ship_package

SEQUENCE = 2048
END_ID = 0
BLOCK_PIECES = 1 << 19
KNOWN_PIECES = 1_000_000
CALL_CHARS = 1 << 12
TEXT_BLOCK = 1 << 21
OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
SAFE_END = 0x3000  # characters from here on are left to the tokenizer
_STATE: dict[str, object] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _classes() -> np.ndarray:
    """Class of every code point for the cutting rule."""
    out = np.full(0x110000, UNSURE, np.uint8)
    for point in range(SAFE_END):
        kind = unicodedata.category(chr(point))
        if kind == "Cn" or 0x1C <= point <= 0x1F or point == 0x180E:
            continue
        blank = kind[0] == "Z" or 9 <= point <= 13 or point == 0x85
        out[point] = (
            SPACE if blank else LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER
        )
    return out


def piece_starts(points: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in code points of rows that lie one after another.

    Rule of the vocabulary: contractions, else runs of letters, numbers or others with
    one blank before them, else white space without the blank that goes to a run.
    """
    size = len(points)
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    last = first[1:]
    first = first[:-1]
    space = kinds == SPACE
    before = np.empty(size, np.uint8)
    before[:1], before[1:] = OTHER, kinds[:-1]
    after_blank = np.zeros(size, bool)
    after_blank[1:] = points[:-1] == 32
    after_space = np.zeros(size, bool)
    after_space[1:] = space[:-1]
    next_black = np.zeros(size, bool)
    next_black[:-1] = ~space[1:]
    start = np.where(
        space, ~after_space | (next_black & ~last), (kinds != before) & ~after_blank
    )
    start |= first
    quote = np.flatnonzero((points == 39) & start)
    if len(quote):
        row_end = offsets[np.searchsorted(offsets, quote, "right")]
        room = row_end - quote
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        long = np.zeros(len(quote), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1])) & (room > 2)
        short = np.isin(one, [ord(c) for c in "stmd"]) & (room > 1)
        for which, width in ((short, 2), (long, 3)):
            at = quote[which]
            start[at + 1] = False
            at = at[room[which] > width] + width
            start[at] |= kinds[at] != SPACE
            start[at] |= True
    return np.flatnonzero(start)


class PieceTable:
    """Ids of pre-tokens seen by this worker, as arrays sorted by their hashes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path, self.tool = path, Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True
        self.kinds = _classes()
        words = self.tool.get_vocab()
        self.width = np.zeros(max(words.values()) + 1, np.int64)
        for word, number in words.items():
            self.width[number] = len(word)  # the vocabulary writes a byte as one character
        self.clear()

    def clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.begins = self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tool.encode(text, add_special_tokens=False).ids, "<u4")

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single pre-tokens, and how many each has.

        They go to the library as one text: those without a blank in front are set off
        by line breaks, whose id is dropped again.
        """
        blank = [p.isspace() for p in pieces]
        text, ends, wanted, at = [], [], [], 0
        for piece, lone in zip(pieces, blank):
            if lone:
                continue
            if piece[0] != " ":
                text.append("\n")
                at += 1
                ends.append(at)
                wanted.append(False)
            text.append(piece)
            at += len(piece.encode())
            ends.append(at)
            wanted.append(True)
        # the library's time for one call grows faster than the text
        calls, length = [[]], 0
        for part in text:
            if length > CALL_CHARS:
                calls.append([])
                length = 0
            calls[-1].append(part)
            length += len(part) if part != "\n" else 0
        ids = np.concatenate([self.whole("".join(call)) for call in calls])
        upto = np.concatenate([[0], np.cumsum(self.width[ids])])
        cuts = np.searchsorted(upto, [0, *ends])
        wanted = np.array(wanted, bool)
        counts = np.diff(cuts)
        ids = ids[np.repeat(wanted, counts)]
        if not any(blank):
            return ids, counts[wanted]
        # white space on its own: few kinds, one call each
        parts, k, at = [], 0, 0
        counts = counts[wanted]
        for piece, lone in zip(pieces, blank):
            if lone:
                parts.append(self.whole(piece))
            else:
                parts.append(ids[at : at + counts[k]])
                at, k = at + counts[k], k + 1
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def rows(self, names: np.ndarray, text_of) -> np.ndarray:
        """Places of sorted hashes in the table, after adding those not yet in it."""
        at = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        new = self.names[at] != names if len(self.names) else np.ones(len(names), bool)
        if new.any():
            ids, counts = self.encoded(text_of(np.flatnonzero(new)))
            begins = len(self.flat) + np.cumsum(counts) - counts
            self.flat = np.concatenate([self.flat, ids])
            held = np.concatenate([self.names, names[new]])
            order = np.argsort(held, kind="stable")
            self.names = held[order]
            self.begins = np.concatenate([self.begins, begins])[order]
            self.lengths = np.concatenate([self.lengths, counts])[order]
            at = np.searchsorted(self.names, names)
        return at


def _table(path: str) -> PieceTable:
    if path not in _STATE:
        _STATE[path] = PieceTable(path)
    return _STATE[path]


def segments(text: str, limit: int) -> list[str]:
    """``text`` cut before single blanks between words, where ids do not change."""
    out, start = [], 0
    while len(text) - start > limit:
        cut, end = -1, start + limit
        while cut < 0:
            cut = text.rfind(" ", start + 1, end)
            if cut < 0:
                break
            if text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace():
                cut, end = -1, cut
        if cut < 0:
            break
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]]


def token_ids(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text, little-endian unsigned 32 bits, exactly as the library gives."""
    table = _table(path)
    out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
    easy = [r for r, t in enumerate(texts) if t]
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kinds = table.kinds[points]
    if (kinds == UNSURE).any():
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        unsure = A.row_sums((kinds == UNSURE).astype(np.int64), offsets) > 0
        for row in np.flatnonzero(unsure):
            out[row] = table.whole(texts[row])
        easy = [r for r in easy if not unsure[r]]
        whole = "".join(texts[r] for r in easy)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kinds = table.kinds[points]
    if not easy:
        return out
    offsets = np.concatenate([[0], np.cumsum([len(texts[r]) for r in easy])]).astype(np.int64)
    starts = piece_starts(points, offsets, kinds)
    ends = np.append(starts[1:], len(points))
    names, lead, which = np.unique(
        A.span_hashes(points, starts, ends), return_index=True, return_inverse=True
    )
    if len(table.names) > KNOWN_PIECES:
        table.clear()
    at = table.rows(names, lambda new: [whole[starts[k] : ends[k]] for k in lead[new]])[which]
    each = table.lengths[at]
    ends = np.cumsum(each)
    ids = table.flat[np.repeat(table.begins[at] - (ends - each), each) + np.arange(int(ends[-1]))]
    bounds = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]
    for k, row in enumerate(easy):
        out[row] = ids[bounds[k] : bounds[k + 1]]
    return out


def _pieces(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, offsets = A.text_bytes(whole.column("text"))
            for a, b in A.row_blocks(offsets, TEXT_BLOCK):
                batch = whole.slice(a, b - a)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                rows: list[list] = [[], [], [], [], [], []]
                parts = [segments(t, TEXT_BLOCK) for t in texts]
                if max(map(len, parts)) > 1:  # a single very long text
                    encoded = [
                        np.concatenate([token_ids([p], path)[0] for p in part]) for part in parts
                    ]
                else:
                    encoded = token_ids(texts, path)
                for row, ids in enumerate(encoded):
                    ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                    cuts = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
                    for piece, (start, end) in enumerate(zip(cuts[:-1], cuts[1:])):
                        held = ids[start:end].tobytes()
                        values = (row, piece, start, end - start, zlib.crc32(held), held)
                        for column, value in zip(rows, values):
                            column.append(value)
                columns = [
                    batch.column("doc_id").take(pa.array(rows[0], pa.int32())),
                    pa.array(rows[1], pa.int32()),
                    *(pa.array(rows[k], pa.int64()) for k in (2, 3, 4)),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(rows[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def fill_bins(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every piece, minimum bin slack.

    Every bin starts with the longest piece left; the rest is the fullest sum that the
    lengths left can give, longer ones preferred.
    """
    order = np.argsort(-lengths, kind="stable")
    stock: dict[int, list[int]] = {}
    for item in order[::-1].tolist():
        stock.setdefault(int(lengths[item]), []).append(item)
    sizes = sorted(stock, reverse=True)
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0

    def take(length: int, place: int) -> int:
        item = stock[length].pop()
        if not stock[length]:
            del stock[length]
            sizes.remove(length)
        bins[item], places[item] = number, place
        return place + length

    while sizes:
        place = take(sizes[0], 0)
        room = size - place
        if room > 0 and sizes and sizes[-1] <= room:
            goal, keep = 1 << room, (2 << room) - 1
            reach, steps = 1, []
            for length in sizes:
                if length > room:
                    continue
                for _ in range(min(len(stock[length]), room // length)):
                    wider = (reach | reach << length) & keep
                    if wider == reach:
                        break
                    steps.append((length, reach))
                    reach = wider
                    if reach & goal:
                        break
                if reach & goal:
                    break
            total = reach.bit_length() - 1
            for length, before in reversed(steps):
                if not before >> total & 1:
                    place = take(length, place)
                    total -= length
        number += 1
    return bins, places


def _pack(size: int, block: int):
    def flush(tables: list[pa.RecordBatch], base: int) -> tuple[pa.RecordBatch, int]:
        table = pa.Table.from_batches(tables).combine_chunks()
        bins, places = fill_bins(table.column("length").to_numpy(), size)
        table = table.append_column("sequence_id", pa.array(bins + base))
        table = table.append_column("offset", pa.array(places))
        return table.to_batches()[0], base + int(bins.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, count = TaskContext.get().partitionId() << 40, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= block:
                out, base = flush(held, base)
                held, count = [], 0
                yield out
        if held:
            yield flush(held, base)[0]

    return run


def packed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    tokenizer: str | None = None,
    with_ids: bool = False,
    block: int = BLOCK_PIECES,
) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of ``size`` tokens.

    A document is its ids followed by id 0. Only longer ones are cut; all pieces but
    the first are full. Returns (doc_id, piece, start, length, ids_crc32, [ids,]
    sequence_id, offset). Null and empty texts are the single id 0. Strings of special
    tokens inside texts are ordinary text. Repeated rows are packed each. Other columns
    are ignored; ``docs`` without rows gives no rows. ``tokenizer`` is a file that every
    machine can read at that path.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fields = [
        T.StructField("doc_id", own.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    pieces = own.mapInArrow(
        _pieces(tokenizer or default_tokenizer(), size, with_ids), T.StructType(fields)
    )
    fields += [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    # ids that repeat or are null are spread by what else tells pieces apart
    dealt = pieces.repartition("doc_id", "piece", "ids_crc32")
    ordered = dealt.sortWithinPartitions("doc_id", "piece", "start", "length", "ids_crc32")
    return ordered.mapInArrow(_pack(size, block), T.StructType(fields))
