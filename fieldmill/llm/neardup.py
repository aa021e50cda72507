"""Near-duplicate documents: one-permutation MinHash, bands, star edges, exact links.

1. Each text becomes the set of its word shingles (64-bit hashes). One hash per
   shingle fills 96 bins (one permutation); empty bins borrow from a random full
   bin (optimal densification). 24 bands of 4 bins are the bucket keys: a pair at
   similarity 0.8 shares no band with a chance of about 3 in a million.
2. Documents with equal sets form one class; only classes go on.
3. In every bucket each class gets one edge to the bucket's smallest class, so a
   bucket of n classes has n - 1 edges. Connected stars are clusters: no linked pair
   that shares a bucket is ever in two clusters.
4. Clusters are cut into blocks of a fixed number of shingles. One task holds two
   blocks at most and compares full sets of the pairs that share a band and are not
   yet connected; it returns the links that connect something new.
5. Components of the links give the group of every document.

Nothing is capped or dropped; a huge cluster becomes more pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .common import components, discard, ship_package, stage

BANDS, ROWS = 24, 4
BINS = BANDS * ROWS
BLOCK_SHINGLES = 1 << 18
DOC_WEIGHT = 64  # counted in a block for each document besides its shingles


def _donors() -> np.ndarray:
    """For each bin a random order of all bins, its own first."""
    draw = np.random.Generator(np.random.PCG64(7))
    order = np.array([draw.permutation(BINS) for _ in range(BINS)])
    return np.array([[k, *row[row != k]] for k, row in enumerate(order)])


DONORS = _donors()


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and where each row begins."""
    data, offsets = A.text_bytes(column)
    data = A.LOWER[data]
    starts, ends, first = A.word_spans(data, offsets, A.SPACED)
    runs, first = A.run_hashes(A.span_hashes(data, starts, ends), first, width)
    sets = [np.unique(runs[a:b]) for a, b in zip(first[:-1], first[1:])]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *sets]), at


def band_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """BANDS bucket keys of each row that has shingles (rows without: zeros)."""
    rows = len(at) - 1
    row = np.repeat(np.arange(rows), np.diff(at))
    cell = row * BINS + ((hashes >> A.U(32)) * A.U(BINS) >> A.U(32)).astype(np.int64)
    # hashes ascend within a row, so the first one of each bin is its smallest
    lead = np.ones(len(cell), bool)
    lead[1:] = cell[1:] != cell[:-1]
    values = np.zeros(rows * BINS, np.uint64)
    full = np.zeros(rows * BINS, bool)
    values[cell[lead]] = hashes[lead]
    full[cell[lead]] = True
    values, full = values.reshape(rows, BINS), full.reshape(rows, BINS)
    for r in np.flatnonzero(~full.all(axis=1) & (np.diff(at) > 0)):
        donor = DONORS[np.arange(BINS), full[r][DONORS].argmax(axis=1)]
        values[r] = values[r][donor]
    weights = A.odd_numbers(BINS, 31).reshape(BANDS, ROWS)
    keys = (values.reshape(rows, BANDS, ROWS) * weights).sum(axis=2, dtype=np.uint64)
    return A.mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128 bits naming the whole set of each row."""
    two = np.stack([A.mixed(hashes), A.mixed(hashes ^ A.U(0x9E3779B97F4A7C15))], axis=1)
    return A.row_sums(two, at) + np.diff(at).astype(np.uint64)[:, None]


def _list_array(flat: pa.Array, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat)


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, offsets = A.text_bytes(whole.column("text"))
            for a, b in A.row_blocks(offsets, 4 * A.CHUNK):
                batch = whole.slice(a, b - a)
                hashes, at = shingle_sets(batch.column("text"), width)
                keys, rows = set_keys(hashes, at), len(at) - 1
                bands = band_keys(hashes, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_hash"),
                        pa.array(np.diff(at)),
                        pa.array([k.tobytes() for k in keys], pa.binary()),
                        pa.array(keys[:, 0].view(np.int64)),
                        _list_array(pa.array(bands.ravel()), np.arange(rows + 1) * BANDS),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_key", "node", "bands"],
                )

    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # classes of this task; repeated rows bring a class again
        for whole in batches:
            _, offsets = A.text_bytes(whole.column("text"))
            for a, b in A.row_blocks(offsets, 4 * A.CHUNK):
                batch = whole.slice(a, b - a)
                hashes, at = shingle_sets(batch.column("text"), width)
                found = [k.tobytes() for k in set_keys(hashes, at)]
                same = []
                for k, (x, y) in enumerate(zip(found, batch.column("set_key").to_pylist())):
                    if x == y and x not in seen:
                        seen.add(x)
                        same.append(k)
                same = np.array(same, np.int64)
                bands = band_keys(hashes, at)[same]
                sets = [hashes[at[r] : at[r + 1]].tobytes() for r in same]
                kept = batch.take(pa.array(same))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("cluster"),
                        kept.column("blocks"),
                        kept.column("set_key"),
                        pa.array(sets, pa.binary()),
                        _list_array(pa.array(bands.ravel()), np.arange(len(same) + 1) * BANDS),
                    ],
                    ["cluster", "blocks", "set_key", "shingles", "bands"],
                )

    return run


def connecting_links(
    sets: list[np.ndarray], bands: np.ndarray, side: np.ndarray, share: int
) -> list[tuple[int, int]]:
    """Links among the sets that connect something not yet connected.

    Compared are pairs that share a band; with two sides, pairs of different sides
    only. A pair is linked if 100 * intersection >= share * union.
    """
    sizes = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(sizes)])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    root = np.arange(len(sets))
    mark = np.zeros(int(flat.max()) + 1 if len(flat) else 1, bool)
    crossing = len(np.unique(side)) > 1
    links = []
    for x in np.argsort(-sizes, kind="stable"):
        near = (bands == bands[x]).any(axis=1) & (root != root[x])
        near &= (100 * sizes >= share * sizes[x]) & (100 * sizes[x] >= share * sizes)
        if crossing:
            near &= side != side[x]
        others = np.flatnonzero(near)
        if not len(others):
            continue
        mark[flat[at[x] : at[x + 1]]] = True
        lengths = sizes[others]
        begins = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) + np.repeat(at[others] - begins, lengths)
        shared = np.add.reduceat(mark[flat[place]], begins, dtype=np.int64)
        mark[flat[at[x] : at[x + 1]]] = False
        linked = others[100 * shared >= share * (lengths + sizes[x] - shared)]
        for y in linked:
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                links.append((int(x), int(y)))
    return links


def _block_links(share: int):
    def run(table: pa.Table) -> pa.Table:
        names = table.column("set_key").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        bands = np.array(table.column("bands").to_pylist(), np.int64).reshape(-1, BANDS)
        side = np.array(table.column("block").to_pylist())
        links = connecting_links(sets, bands, side, share)
        links = [(names[x], names[y]) for x, y in links if names[x] != names[y]]
        columns = [pa.array([k[n] for k in links], pa.binary()) for n in (0, 1)]
        return pa.Table.from_arrays(columns, ["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    share: int = 80,
    block: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Group of near-duplicates of every document.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` after A-Z became lower case. Documents with
    ``100 * intersection >= share * union`` of their ``width``-word shingles are linked.

    Returns (doc_id, text_hash, n_shingles, component_id, kept), one row per row of
    ``docs``. Null text and text without words: 0 shingles, linked with nothing, its own
    component. Fewer words than ``width``: one shingle. Repeated rows share a component;
    all rows of the smallest id are kept. A null id is never a component's id unless all
    its documents have none; those are all kept. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    kind = own.schema["doc_id"].dataType
    sketch_type = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("node", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    sketches, _ = stage(own.mapInArrow(_sketch(width), sketch_type))

    classes, classes_path = stage(
        sketches.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(
            # of a class the row with the smallest id speaks; rows without an id come last
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"),
            F.any_value("node").alias("node"),
            F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("bands").alias("bands"),
        )
        .select("set_key", "first.doc_id", "first.text_hash", "node", "n_shingles", "bands")
        .withColumnRenamed("doc_id", "first_id")
        .withColumnRenamed("text_hash", "first_hash")
    )
    cells = classes.select("node", F.explode("bands").alias("band"))
    hubs = cells.groupBy("band").agg(F.min("node").alias("hub"), F.count("node").alias("n"))
    stars = (
        cells.join(hubs.where("n > 1").select("band", "hub"), "band")
        .where("node <> hub")
        .select("node", "hub")
        .distinct()
    )
    clusters, clusters_path = stage(components(stars, "node", "hub"))

    members = classes.join(clusters, "node").select(
        "set_key", "first_id", "first_hash", "n_shingles", F.col("root").alias("cluster")
    )
    weights = members.groupBy("cluster").agg(
        F.ceil(F.sum(F.col("n_shingles") + DOC_WEIGHT) / F.lit(block)).alias("blocks")
    )
    members = members.join(weights, "cluster").drop("n_shingles")
    sets_type = (
        "cluster long, blocks long, set_key binary, shingles binary, bands array<long>"
    )
    sets = (
        own.join(
            members.hint("shuffle_hash"),
            # the text's hash keeps rows of one id, or of none, from meeting each other's classes
            (own["text_hash"] == members["first_hash"])
            & own["doc_id"].eqNullSafe(members["first_id"]),
        )
        .select("text", "set_key", "cluster", "blocks")
        .mapInArrow(_full_sets(width), sets_type)
    )
    mine = F.pmod(F.xxhash64("set_key"), F.col("blocks"))
    dealt = sets.withColumn("block", mine).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    links = (
        dealt.withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("cluster", "i", "j", "set_key", "shingles", "bands", "block")
        .groupBy("cluster", "i", "j")
        .applyInArrow(_block_links(share), "a binary, b binary")
    )
    roots = components(links, "a", "b").withColumnRenamed("node", "set_key")
    roots, _ = stage(roots.join(classes.select("set_key", "first_id"), "set_key"))
    tops = roots.groupBy("root").agg(F.min("first_id").alias("top"))
    named = classes.select("set_key", "first_id").join(
        roots.join(tops, "root").select("set_key", "top"), "set_key", "left"
    )
    named, _ = stage(named.select("set_key", F.coalesce("top", "first_id").alias("component_id")))
    discard(spark, clusters_path)
    discard(spark, classes_path)

    narrow = sketches.select("doc_id", "text_hash", "n_shingles", "set_key")
    out = (
        narrow.where("n_shingles > 0")
        .join(named, "set_key", "left")
        .unionByName(narrow.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")))
    )
    return out.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, share: int = 80) -> DataFrame:
    """``docs`` with one document of each group, with the columns of ``docs``.

    Documents without words are not linked and stay. Of rows that repeat id and text
    one stays. Rows are told apart by id and text.
    """
    found, _ = stage(near_duplicates(docs, width=width, share=share))
    keyed = found.groupBy("doc_id", "text_hash").agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("times")
    )
    odd = keyed.where("not kept or times > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "kept"
    )
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & F.xxhash64(docs["text"]).eqNullSafe(
        F.col("_hash")
    )
    plain = docs.join(odd.hint("shuffle_hash"), same, "left_anti")
    repeated = docs.join(odd.where("kept").hint("shuffle_hash"), same, "left_semi")
    return plain.unionByName(repeated.dropDuplicates(["doc_id", "text"]))
