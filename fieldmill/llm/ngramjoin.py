"""Jaccard join on word n-grams: rare-first prefixes with length, positional and suffix filters.

1. Every shingle has a place in one order for all documents: by an estimate of how many
   documents hold it (counters of a fixed table, filled from all documents), then by hash.
   The order alone decides correctness of the prefixes; that it is rare-first keeps the
   groups of step 3 small.
2. Documents with equal sets are one class. A pair of classes at or above the wanted
   similarity shares one of the first n - ceil(t n) + 1 shingles of each.
   A pair also shares MATCHES of the first n - ceil(t n) + MATCHES, if it shares so many.
3. Classes that share a prefix shingle and fit in length form a chain in order of size. In
   a chain of at most SMALL classes each meets the others; pairs that meet MATCHES times
   are candidates. A longer chain of m classes gives m - 1 edges to its first one.
   Expected large groups are split by a salt, and the chains of their parts are chained.
4. Each class is first verified against one other, of its candidates and heads the one it
   shares most prefix shingles with, which settles groups of near copies in linear work.
   Then follow the candidates that are still unconnected. What longer chains connect and
   links do not is cut into blocks of a bounded number of shingles: everything outside the
   largest part meets everything else, by a prefix index with length, positional and
   suffix filter. A pair is verified at most once in each of these steps, and not at all
   if links already connect it.
5. Components of the verified links are the result.

Nothing is capped: more classes make more chains, more blocks and more tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import components, discard, ship_package, stage
from .neardup import set_keys, shingle_sets

CELLS = 1 << 22
SEGMENT = 1 << 18
STEPS = 10  # levels for each doubling of the estimated frequency
SALT_ROWS = 1 << 16
MATCHES = 4
SMALL = 16
BLOCK_SHINGLES = 1 << 18
CLASS_WEIGHT = 64  # counted in a block for each class besides its shingles
PIVOTS = 7
COUNTS = "segment long, counts binary"
CHAINED = "token long, a long, b long, lo long, hi long, is_long boolean"


def prefix_length(sizes: np.ndarray, share: int, matches: int = 1) -> np.ndarray:
    """How many first shingles hold ``matches`` common ones of a pair that has so many."""
    return np.minimum(sizes - (share * sizes + 99) // 100 + matches, sizes)


def least_overlap(x: int, y: np.ndarray, share: int) -> np.ndarray:
    """Common shingles that sets of these sizes need."""
    return -(-share * (x + y) // (100 + share))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        _, offsets = A.text_bytes(whole.column("text"))
        for a, b in A.row_blocks(offsets, 4 * A.CHUNK):
            yield whole.slice(a, b - a)


def _cell_counts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for batch in _blocks(batches):
            hashes, _ = shingle_sets(batch.column("text"), width)
            counts += np.bincount((hashes >> A.U(42)).astype(np.int64), minlength=CELLS)
        # two bytes a cell and task: an estimate needs no more
        parts = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, SEGMENT)
        for segment in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(segment)], pa.int64()), pa.array([parts[segment].tobytes()])],
                ["segment", "counts"],
            )

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, segment = np.zeros(SEGMENT, np.int64), None
    for batch in batches:
        segment = batch.column("segment")[:1]
        for part in batch.column("counts"):
            total += np.frombuffer(part.as_py(), np.uint16)
    levels = np.minimum(np.rint(STEPS * np.log2(1.0 + total)), 255).astype(np.uint8)
    yield pa.RecordBatch.from_arrays([segment, pa.array([levels.tobytes()])], ["segment", "counts"])


def frequency_levels(texts: DataFrame, width: int) -> np.ndarray:
    """Level of every cell: STEPS times log2 of the documents whose shingles fall into it."""
    parts = texts.select("text").mapInArrow(_cell_counts(width), COUNTS)
    merged = parts.groupBy("segment").applyInArrow(_levels, COUNTS)
    out = np.zeros((CELLS // SEGMENT, SEGMENT), np.uint8)
    for row in merged.collect():  # CELLS bytes
        out[row["segment"]] = np.frombuffer(row["counts"], np.uint8)
    return out.ravel()


def ordered_sets(hashes: np.ndarray, at: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingles as numbers whose size is their place in the common order, ascending by row."""
    level = levels[(hashes >> A.U(42)).astype(np.int64)].astype(np.uint64)
    places = (level << A.U(56)) | (hashes >> A.U(8))
    return places[np.lexsort((places, np.repeat(np.arange(len(at) - 1), np.diff(at))))]


def _sketch(width: int, share: int, shared):
    salt_rows = SALT_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # prefixes of equal sets leave a task once
        for batch in _blocks(batches):
            hashes, at = shingle_sets(batch.column("text"), width)
            names, sizes = set_keys(hashes, at), np.diff(at)
            nodes = names[:, 0].view(np.int64)
            new = np.zeros(len(sizes), bool)
            for r in np.flatnonzero(sizes):
                if (node := int(nodes[r])) not in seen:
                    seen.add(node)
                    new[r] = True
            wanted = np.where(new, prefix_length(sizes, share, MATCHES), 0)
            places = ordered_sets(hashes, at, shared.value)
            inner = np.arange(len(places)) - np.repeat(at[:-1], sizes)
            tokens = places[inner < np.repeat(wanted, sizes)]
            expected = np.exp2((tokens >> A.U(56)).astype(float) / STEPS)
            salts = np.ceil(expected / salt_rows).astype(np.uint64)
            salt = np.repeat(names[:, 1], wanted) % salts
            keys = A.mixed(tokens + salt * A.U(0x9E3779B97F4A7C15)).view(np.int64)
            split = np.where(salts > 1, tokens.view(np.int64), 0)
            ends = np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in (keys, split)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes),
                    pa.array([k.tobytes() for k in names], pa.binary()),
                    pa.array(nodes),
                    *lists,
                ],
                ["doc_id", "text_hash", "n_shingles", "set_key", "node", "keys", "tokens"],
            )

    return run


def _chains(share: int, parts: bool):
    """Pairs of short chains, edges of long ones to their head, spans of chains that are parts.

    Rows come sorted by (key, lo, node). A row belongs to the chain before it if some size
    of the chain may be similar to its smallest one. With ``parts`` the rows are spans of
    chains and every chain is long, as are those of the parts of a split group.
    """

    small = SMALL  # carried into the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "token", "lo", "hi", "node", "long")
        held = [np.zeros(0, np.int64) for _ in names]  # the open chain, a long one as its head
        for batch in _and_end(batches):
            rows = held
            if batch is not None:
                new = [batch.column(c).to_numpy(zero_copy_only=False) for c in names[:5]]
                new.append(np.full(len(new[0]), int(parts)))
                rows = [np.concatenate([h, n]).astype(np.int64) for h, n in zip(held, new)]
            key, token, lo, hi, node, long = rows
            if not len(key):
                continue
            once = np.ones(len(key), bool)  # equal sets of several tasks follow each other
            once[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (lo[1:] != lo[:-1])
            key, token, lo, hi, node, long = (v[once] for v in (key, token, lo, hi, node, long))
            group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
            top = np.maximum.accumulate((group << 40) + hi) - (group << 40)
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (100 * top[:-1] < share * lo[1:])
            first = np.flatnonzero(fresh)
            chain, last = np.cumsum(fresh) - 1, np.append(first[1:], len(key)) - 1
            is_long = np.maximum.reduceat(long, first) + (last - first >= small) + (token[first] != 0) > 0
            closed = np.ones(len(first), bool)
            closed[-1] = batch is None
            head = node[first][chain]
            out = is_long[chain] & (node != head)
            pairs = [(np.zeros(out.sum(), np.int64), node[out], head[out], out[out])]
            short = ~is_long & closed
            for d in range(1, small):
                at = np.flatnonzero(short[chain[d:]] & (chain[d:] == chain[:-d])) + d
                at = at[100 * lo[at - d] >= share * lo[at]]
                pairs.append((np.zeros(len(at), np.int64), node[at], node[at - d], np.zeros(len(at), bool)))
            ends = np.flatnonzero(closed & (token[first] != 0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*(p[0] for p in pairs), token[first[ends]]])),
                    pa.array(np.concatenate([*(p[1] for p in pairs), node[first[ends]]])),
                    pa.array(np.concatenate([*(p[2] for p in pairs), node[first[ends]]])),
                    pa.array(np.concatenate([*(p[0] for p in pairs), lo[first[ends]]])),
                    pa.array(np.concatenate([*(p[0] for p in pairs), top[last[ends]]])),
                    pa.array(np.concatenate([*(p[3] for p in pairs), np.ones(len(ends), bool)])),
                ],
                ["token", "a", "b", "lo", "hi", "is_long"],
            )
            a = first[-1]
            if is_long[-1]:
                held = [v[a : a + 1].copy() for v in (key, token, lo, hi, node, long)]
                held[3][:], held[5][:] = top[-1], 1
            else:
                held = [v[a:] for v in (key, token, lo, hi, node, long)]

    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _chained(rows: DataFrame, share: int, parts: bool = False) -> DataFrame:
    dealt = rows.repartition("key").sortWithinPartitions("key", "lo", "node")
    return dealt.mapInArrow(_chains(share, parts), CHAINED)


def candidate_edges(sketches: DataFrame, share: int) -> tuple[DataFrame, str]:
    """(a, b, shared, is_long): classes that meet in ``shared`` chains; is_long: in a long one.

    Pairs of short chains alone are left out if they meet less than MATCHES times, or less
    often than sets of their sizes need common shingles.
    """
    cells = (
        sketches.where(F.size("keys") > 0)
        .select("node", "n_shingles", F.explode(F.arrays_zip("keys", "tokens")).alias("c"))
        .select(
            F.col("c.keys").alias("key"),
            F.col("c.tokens").alias("token"),
            F.col("n_shingles").alias("lo"),
            F.col("n_shingles").alias("hi"),
            "node",
        )
    )
    first, first_path = stage(_chained(cells, share))
    parts = first.where("token <> 0").select(
        F.col("token").alias("key"), F.lit(0).cast("long").alias("token"), "lo", "hi", F.col("a").alias("node")
    )
    edges = first.where("token = 0").unionByName(_chained(parts, share, parts=True))
    counted = edges.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("shared"), F.max("is_long").alias("is_long")
    )
    sizes = sketches.where(F.size("keys") > 0).select("node", F.col("n_shingles").alias("n")).distinct()
    few = counted.where((F.col("shared") < MATCHES) & ~F.col("is_long"))
    need = F.ceil(F.lit(share) * (F.col("n") + F.col("m")) / F.lit(100 + share))
    few = (
        few.join(sizes.where(F.col("n") < 2 * MATCHES).withColumnRenamed("node", "a"), "a")
        .join(sizes.withColumnRenamed("node", "b").withColumnRenamed("n", "m"), "b")
        .where(F.col("shared") >= need)
        .select(counted.columns)
    )
    out = stage(counted.where((F.col("shared") >= MATCHES) | F.col("is_long")).unionByName(few))
    discard(sketches.sparkSession, first_path)
    return out


def _full_sets(width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in _blocks(batches):
            hashes, at = shingle_sets(batch.column("text"), width)
            names = [k.tobytes() for k in set_keys(hashes, at)]
            places = ordered_sets(hashes, at, shared.value)
            same = []
            for r, (own, wanted) in enumerate(zip(names, batch.column("set_key").to_pylist())):
                if own == wanted and own not in seen:
                    seen.add(own)
                    same.append(r)
            kept = batch.take(pa.array(same, pa.int64()))
            sets = [places[at[r] : at[r + 1]].tobytes() for r in same]
            yield pa.RecordBatch.from_arrays(
                [kept.column("node"), kept.column("set_key"), pa.array(sets, pa.binary())],
                ["node", "set_key", "places"],
            )

    return run


class Sets:
    """Sets of one task as ranks in the common order, one behind the other."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        values, flat = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
        self.flat, self.kinds = flat.astype(np.int64), len(values)
        # ascending over all sets, for places of a rank within each set
        self.keyed = self.flat + np.repeat(np.arange(len(sets)), self.sizes) * self.kinds
        self.mark = np.zeros(self.kinds, bool)

    def of(self, x: int) -> np.ndarray:
        return self.flat[self.at[x] : self.at[x + 1]]

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """Common shingles of x and each of ``others``."""
        lengths = self.sizes[others]
        begins = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) + np.repeat(self.at[others] - begins, lengths)
        self.mark[self.of(x)] = True
        out = np.add.reduceat(self.mark[self.flat[place]], begins, dtype=np.int64)
        self.mark[self.of(x)] = False
        return out

    def most_common(self, x: int, behind_x: np.ndarray, others: np.ndarray, behind: np.ndarray):
        """Upper bound of the common shingles behind given places of x and each other set.

        Both rests are cut at the same pivots; a part holds no more common shingles than
        the smaller of its two sides.
        """
        steps = np.arange(1, PIVOTS + 1)
        cuts_x = behind_x[:, None] + (self.sizes[x] - behind_x)[:, None] * steps // (PIVOTS + 1)
        pivots = self.of(x)[np.minimum(cuts_x, self.sizes[x] - 1)]
        found = np.searchsorted(self.keyed, others[:, None] * self.kinds + pivots)
        cuts_y = np.maximum(found - self.at[others][:, None], behind[:, None])
        size_x = np.diff(cuts_x, axis=1, prepend=behind_x[:, None], append=np.full((len(others), 1), self.sizes[x]))
        size_y = np.diff(cuts_y, axis=1, prepend=behind[:, None], append=self.sizes[others][:, None])
        return np.minimum(size_x, size_y).sum(axis=1)


def similar(x: int, y: np.ndarray, common: np.ndarray, share: int) -> np.ndarray:
    return 100 * common >= share * (x + y - common)


def joined_pairs(
    sets: list[np.ndarray], side: np.ndarray, root: np.ndarray, share: int
) -> list[tuple[int, int]]:
    """Similar pairs that connect sets with different roots.

    With two sides, pairs of different sides only. Sets come in by size; each looks up its
    prefix in an index of the smaller ones.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    held = Sets([sets[k] for k in order])
    side, root = side[order], np.unique(root[order], return_inverse=True)[1]
    crossing = len(np.unique(side)) > 1
    wanted = prefix_length(held.sizes, share)
    inner = np.arange(len(held.flat)) - np.repeat(held.at[:-1], held.sizes)
    entry = np.flatnonzero(inner < np.repeat(wanted, held.sizes))
    owner, place, rank = np.repeat(np.arange(len(sets)), wanted), inner[entry], held.flat[entry]
    by_rank = np.lexsort((owner, rank))
    spot = np.empty(len(entry), np.int64)
    spot[by_rank] = np.arange(len(entry))
    begin = np.searchsorted(rank[by_rank], rank)
    first = np.concatenate([[0], np.cumsum(wanted)])
    links = []
    for x in range(len(sets)):
        own = np.arange(first[x], first[x + 1])
        counts = spot[own] - begin[own]
        total = int(counts.sum())
        if not total:
            continue
        back = np.cumsum(counts) - counts
        match = by_rank[np.arange(total) + np.repeat(begin[own] - back, counts)]
        size = held.sizes[x]
        y, at_y, at_x = owner[match], place[match], np.repeat(place[own], counts)
        fits = (root[y] != root[x]) & (100 * held.sizes[y] >= share * size)
        if crossing:
            fits &= side[y] != side[x]
        if not fits.any():
            continue
        y, at_y, at_x = y[fits], at_y[fits], at_x[fits]
        # matches come by place in x, so the last of each set is its last common prefix shingle
        others, last, met = np.unique(y[::-1], return_index=True, return_counts=True)
        last = len(y) - 1 - last
        need = least_overlap(int(size), held.sizes[others], share)
        behind_x, behind = at_x[last] + 1, at_y[last] + 1
        able = met + np.minimum(size - behind_x, held.sizes[others] - behind) >= need
        others, met, need, behind_x, behind = (v[able] for v in (others, met, need, behind_x, behind))
        able = met + held.most_common(x, behind_x, others, behind) >= need
        others, met = others[able], met[able]
        others = others[np.lexsort((-met, root[others]))]
        batch = 1
        while len(others):  # of each root the best ones first; linked roots need no more
            lead = np.concatenate([[0], np.flatnonzero(np.diff(root[others])) + 1])
            nth = np.arange(len(others)) - np.repeat(lead, np.diff(np.append(lead, len(others))))
            now = others[nth < batch]
            for z in now[similar(size, held.sizes[now], held.common(x, now), share)]:
                if root[z] != root[x]:
                    links.append((int(order[x]), int(order[z])))
                    root[root == root[z]] = root[x]
            others = others[(nth >= batch) & (root[others] != root[x])]
            batch *= 2
            others = others[np.argsort(root[others], kind="stable")]
    return links


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    columns = [pa.array([p[n] for p in pairs], pa.binary()) for n in (0, 1)]
    return pa.Table.from_arrays(columns, ["a", "b"])


def _star_links(share: int):
    def run(table: pa.Table) -> pa.Table:
        names = table.column("set_key").to_pylist()
        held = Sets([np.frombuffer(s, np.uint64) for s in table.column("places").to_pylist()])
        is_head = np.array(table.column("is_head").to_pylist(), bool)
        found, others = [], np.flatnonzero(~is_head)
        if len(others):
            for x in np.flatnonzero(is_head):
                ok = similar(held.sizes[x], held.sizes[others], held.common(x, others), share)
                found += [(names[x], names[y]) for y in others[ok] if names[x] != names[y]]
        return _links(found)

    return run


def _block_links(share: int):
    def run(table: pa.Table) -> pa.Table:
        names = table.column("set_key").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("places").to_pylist()]
        side = np.array(table.column("block").to_pylist())
        root = np.array([r.hex() for r in table.column("root").to_pylist()])
        return _links([(names[x], names[y]) for x, y in joined_pairs(sets, side, root, share)])

    return run


def pair_links(sets: DataFrame, pairs: DataFrame, members: DataFrame, share: int, block: int) -> DataFrame:
    """Links among the pairs (node, head); a head with many pairs meets them in several tasks."""
    sizes = members.select("node", "n_shingles")
    parts = (
        pairs.join(sizes, "node")
        .groupBy("head")
        .agg(F.ceil(F.sum(F.col("n_shingles") + CLASS_WEIGHT) / F.lit(block)).alias("parts"))
    )
    fields = ["head", "part", "set_key", "places"]
    points = (
        sets.join(pairs.join(parts, "head"), "node")
        .withColumn("part", F.pmod(F.xxhash64("set_key"), F.col("parts")))
        .select(*fields, F.lit(False).alias("is_head"))
    )
    heads = (
        sets.join(parts.withColumnRenamed("head", "node"), "node")
        .withColumn("head", F.col("node"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(*fields, F.lit(True).alias("is_head"))
    )
    return points.unionByName(heads).groupBy("head", "part").applyInArrow(
        _star_links(share), "a binary, b binary"
    )


def parts_of(members: DataFrame, linked: DataFrame) -> DataFrame:
    """``members`` with the part of the links that each belongs to, at first its own."""
    roots = components(linked, "a", "b").select(F.col("node").alias("set_key"), "root")
    return members.join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))


def block_links(sets: DataFrame, known: DataFrame, chains: DataFrame, share: int, block: int) -> DataFrame:
    """Links between the parts that long chains connect and earlier links do not."""
    clusters = components(chains, "a", "b").withColumnRenamed("root", "cluster")
    known = known.join(clusters, "node").select(
        "set_key", "cluster", "root", (F.col("n_shingles") + CLASS_WEIGHT).alias("weight")
    )
    parts = known.groupBy("cluster", "root").agg(F.sum("weight").alias("weight"))
    heaviest = parts.groupBy("cluster").agg(
        F.max("weight").alias("core_weight"), F.sum("weight").alias("all_weight"), F.count("root").alias("n")
    )
    clusters = (
        parts.join(heaviest.where("n > 1"), "cluster")
        .where("weight = core_weight")
        .groupBy("cluster", "core_weight", "all_weight")
        .agg(F.min("root").alias("core"))
        .select(
            "cluster",
            "core",
            F.ceil((F.col("all_weight") - F.col("core_weight")) / F.lit(block)).alias("outer"),
            F.ceil(F.col("core_weight") / F.lit(block)).alias("inner"),
        )
    )
    own = F.xxhash64("set_key")
    dealt = (
        known.join(clusters, "cluster")
        .withColumn("is_core", F.col("root") == F.col("core"))
        .withColumn(
            "block",
            F.when(F.col("is_core"), F.col("outer") + F.pmod(own, F.col("inner"))).otherwise(
                F.pmod(own, F.col("outer"))
            ),
        )
        .withColumn(
            "meets",
            F.when(F.col("is_core"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")),
        )
        .select("set_key", "cluster", "root", "block", "meets")
    )
    return (
        sets.join(dealt, "set_key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("meets") - 1)))
        .select(
            "cluster",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "root",
            "set_key",
            "places",
        )
        .groupBy("cluster", "i", "j")
        .applyInArrow(_block_links(share), "a binary, b binary")
    )


def ngram_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    share: int = 80,
    block: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Documents grouped by links ``100 * intersection >= share * union`` of their shingles.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` after A-Z became lower case; a document's set
    are its distinct ``width``-word shingles, with fewer words the whole sequence.

    Returns (doc_id, text_hash, n_shingles, component_id), one row per row of ``docs``.
    Null text and text without words: 0 shingles, linked with nothing, its own component.
    Rows with equal sets share a component, repeated rows as well. component_id is the
    smallest id reachable; null only if no document of the component has an id. Other
    columns are ignored. Links are a spanning part of all links: no link between two sets
    that other links connect is needed for the components.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    shared = spark.sparkContext.broadcast(frequency_levels(own, width))
    sketch_type = T.StructType(
        [
            T.StructField("doc_id", own.schema["doc_id"].dataType),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("node", T.LongType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("tokens", T.ArrayType(T.LongType())),
        ]
    )
    sketches, sketches_path = stage(own.mapInArrow(_sketch(width, share, shared), sketch_type))
    edges, edges_path = candidate_edges(sketches, share)
    narrow, narrow_path = stage(
        sketches.select("doc_id", "text_hash", "n_shingles", "set_key", "node")
    )
    discard(spark, sketches_path)
    classes, classes_path = stage(
        narrow.where("n_shingles > 0")
        .groupBy("set_key", "node", "n_shingles")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min_by("text_hash", "doc_id").alias("of_first"),
            F.max("text_hash").alias("of_any"),
        )
        .withColumn("first_hash", F.coalesce("of_first", "of_any"))
        .drop("of_first", "of_any")
    )
    met = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members, members_path = stage(classes.join(met, "node"))
    found = own["doc_id"].eqNullSafe(F.col("first_id")) & (own["text_hash"] == F.col("first_hash"))
    sets, sets_path = stage(
        own.join(members.hint("shuffle_hash"), found)
        .select("text", "node", "set_key")
        .mapInArrow(_full_sets(width, shared), "node long, set_key binary, places binary")
    )
    best = edges.groupBy("a").agg(F.max_by("b", F.col("shared")).alias("b"))
    pairs, pairs_path = stage(best.select(F.col("a").alias("node"), F.col("b").alias("head")))
    stars, stars_path = stage(pair_links(sets, pairs, members, share, block))
    known, known_path = stage(parts_of(members, stars))
    roots = known.select("node", "root")
    open_pairs = (
        edges.where("not is_long")
        .select(F.col("a").alias("node"), F.col("b").alias("head"))
        .join(roots, "node")
        .join(roots.select(F.col("node").alias("head"), F.col("root").alias("of_head")), "head")
        .where("root <> of_head")
        .select("node", "head")
        .join(pairs, ["node", "head"], "left_anti")
    )
    open_pairs, open_path = stage(open_pairs)
    chains = edges.where("is_long").select("a", "b")
    rest, rest_path = stage(
        pair_links(sets, open_pairs, members, share, block).unionByName(
            block_links(sets, known, chains, share, block)
        )
    )
    roots, roots_path = stage(
        components(stars.unionByName(rest), "a", "b").withColumnRenamed("node", "set_key")
    )
    tops = roots.join(classes, "set_key").groupBy("root").agg(F.min("first_id").alias("top"))
    named, _ = stage(
        classes.join(roots.join(tops, "root").select("set_key", "top"), "set_key", "left").select(
            "set_key", F.coalesce("top", "first_id").alias("component_id")
        )
    )
    for path in (
        edges_path, members_path, sets_path, pairs_path, stars_path, known_path, open_path,
        rest_path, roots_path, classes_path,
    ):
        discard(spark, path)
    narrow = narrow.drop("node")
    out = (
        narrow.where("n_shingles > 0")
        .join(named, "set_key", "left")
        .unionByName(narrow.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")))
    )
    return out.select("doc_id", "text_hash", "n_shingles", "component_id")
