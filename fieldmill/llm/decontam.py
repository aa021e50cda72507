"""Benchmark passages in training documents, found by word n-grams.

The windows of all benchmark items form a hash set that goes into the scan of the
documents (a literal set, so every task has its own copy): three words of each document
window are looked up in it, and only the few windows that pass are compared as whole
texts with the broadcast table of windows. A benchmark of more than ``set_limit``
windows is neither made a literal nor broadcast: then all document windows are joined
with the windows of the benchmark. Both ways are exact. All of it is native.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
SET_LIMIT = 200_000
_BREAKS = "".join(
    chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became lower case."""
    plain = F.translate(
        F.coalesce(text, F.lit("")), _BREAKS + _UPPER, " " * len(_BREAKS) + _UPPER.lower()
    )
    plain = F.trim(plain)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _gate(hashes: str, width: int) -> str:
    """SQL for one number per window, made of its first, middle and last word."""
    keys = hashes
    for step, shift in sorted({(width // 2, 1), (width - 1, 2)}):
        if step:
            later = f"slice({hashes}, {step + 1}, size({hashes}))"
            keys = f"zip_with({keys}, {later}, (a, b) -> a ^ shiftleft(b, {shift}))"
    return keys


def benchmark_windows(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW
) -> DataFrame:
    """(item, window, width, gate): every window once for each item that has it."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        words(F.col(text)).alias("words"),
    ).where("size(words) > 0")
    # a shorter item is one window
    items = items.withColumn("width", F.least(F.size("words"), F.lit(width)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1))
    parts = items.select("item", "width", "words", at.alias("at")).select(
        "item", "width", F.slice("words", F.col("at"), F.col("width")).alias("words")
    )
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    parts = parts.withColumn("hashes", hashes)
    gates = F.lit(None).cast("long")
    for n in range(1, width + 1):
        gates = F.when(F.col("width") == n, F.expr(_gate("hashes", n))[0]).otherwise(gates)
    return parts.select(
        "item", F.array_join("words", " ").alias("window"), "width", gates.alias("gate")
    ).distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    set_limit: int = SET_LIMIT,
) -> DataFrame:
    """What each document shares with the benchmark.

    Returns one row per row of ``docs``: (doc_id, text_hash, n_words, n_hit, hit array of
    word positions from 0, items sorted array of ids as text, contaminated). A word is hit
    inside any occurrence of a window of ``width`` consecutive item words; an item of fewer
    words is one window. Null and empty texts have no words. A null item id counts as
    ``null``. Repeated documents give a row each, repeated items count once. Other columns
    are ignored; an empty benchmark hits nothing.
    """
    grams = benchmark_windows(benchmark, item_id, item_text, width)
    held = grams.select("width", "gate").distinct().limit(set_limit + 1).collect()
    small = len(held) <= set_limit
    if small:
        widths = sorted({r.width for r in held})
    else:
        widths = sorted(r.width for r in grams.select("width").distinct().collect())
    own = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        words(F.col(text)).alias("words"),
    ).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    found = F.array().cast("array<struct<at:int,width:int>>")
    for n in widths:
        if small:
            mine = ",".join(f"{r.gate}L" for r in held if r.width == n)
            keep = f"CASE WHEN k IN ({mine}) THEN named_struct('at', i, 'width', {n}) END"
        else:
            keep = f"CASE WHEN k IS NOT NULL THEN named_struct('at', i, 'width', {n}) END"
        hits = F.expr(f"filter(transform({_gate('hashes', n)}, (k, i) -> {keep}), x -> x IS NOT NULL)")
        found = F.concat(found, hits)
    rows = own.select(
        "row", "doc_id", "text_hash", F.size("words").alias("n_words"), "words", found.alias("found")
    ).select("row", "doc_id", "text_hash", "n_words", "words", F.explode_outer("found").alias("f"))
    window = F.array_join(F.slice("words", F.col("f.at") + 1, F.col("f.width")), " ")
    # no window: a key of its own, which no window equals
    rows = rows.withColumn(
        "window", F.coalesce(F.when(F.col("f").isNotNull(), window), F.concat(F.lit("#"), F.col("row").cast("string")))
    ).drop("words")
    grams = grams.select("item", "window")
    matched = rows.join(F.broadcast(grams) if small else grams, "window", "left")
    spots = F.collect_set(F.when(F.col("item").isNotNull(), F.col("f")))
    out = matched.groupBy("row", "doc_id", "text_hash", "n_words").agg(
        spots.alias("spots"), F.array_sort(F.collect_set("item")).alias("items")
    )
    hit = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform("spots", lambda s: F.sequence(s.at, s.at + s.width - 1)))
        )
    )
    return out.withColumn("hit", hit).select(
        "doc_id",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hit").cast("long").alias("n_hit"),
        "hit",
        "items",
        (F.size("hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that share a window with the benchmark."""
    bad = contamination(docs, benchmark, **options).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    return docs.join(bad.hint("shuffle_hash"), same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with hit words, and the separators after each, cut out of ``text``."""
    bad = contamination(docs, benchmark, **options).where("contaminated")
    bad = bad.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("hit").alias("_hit")
    ).dropDuplicates(["_id", "_hash"])
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_hash"))
    rest = _WORD.replace("[^", "[")
    parts = F.regexp_extract_all("text", F.lit(f"{_WORD}(?:{rest[:-1]}*)"), F.lit(0))
    kept = F.filter(parts, lambda p, i: ~F.array_contains("_hit", i))
    lead = F.regexp_extract("text", f"^{rest[:-1]}*", 0)
    cut = F.concat(lead, F.array_join(kept, ""))
    text = F.when(F.col("_hit").isNull(), F.col("text")).otherwise(cut)
    joined = docs.join(bad.hint("shuffle_hash"), same, "left")
    return joined.withColumn("text", text).select(*docs.columns)
