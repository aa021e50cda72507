"""Document fingerprints by consistent weighted sampling.

A text is its words, weighted by how often they occur. For each of SAMPLES samples every
word draws r and c from gamma(2, 1) and b uniformly, all from a hash of word and sample;
t = floor(ln(weight) / r + b), and the word with the smallest
ln c - r * (t - b + 1) gives the sample (word, t). Two texts agree in a sample with a
chance of their generalised Jaccard similarity, sum(min) / sum(max) of the weights.

The draws come from tables of gamma quantiles instead of logarithms of uniform numbers;
the minimum of each sample is an ordinary aggregate. Documents
are shuffled once, by ranges of their id; all further steps stay in these partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 64
DRAWS = 4096
TOGETHER = 8  # samples of one aggregation row; more make a method too long to compile
RANGE_ROWS = 500
MOST_RANGES = 4096


def gamma_quantiles(count: int = DRAWS) -> list[float]:
    """Midpoint quantiles of gamma(2, 1), whose distribution is 1 - (1 + x) exp(-x)."""
    out, x = [], 0.0
    for k in range(count):
        goal = (k + 0.5) / count
        low, high = x, x + 1.0
        while 1 - (1 + high) * math.exp(-high) < goal:
            high += 1.0
        for _ in range(60):
            x = (low + high) / 2
            low, high = (x, high) if 1 - (1 + x) * math.exp(-x) < goal else (low, x)
        out.append(x)
    return out


def _table(values: list[float]) -> Column:
    """A constant array in one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def with_codes(drawn: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the TOGETHER logarithms that a term enters its samples ``_s`` with.

    A code depends on the term, the sample and t alone, so the smallest one names (term, t).
    ``_k`` is the hash of term and ``_g`` with TOGETHER free values below it. A word that
    occurs once has t = 0, as b is less than 1. Hash and draws are columns of their own, each
    computed once; the generated code stays short enough for the JVM to compile.
    """
    more = [*keep, "term", "log_weight", "gammas", "logs"]
    slots = range(TOGETHER)
    drawn = drawn.select(*more, *[F.expr(f"xxhash64(_k + {k}L)").alias(f"_h{k}") for k in slots])
    r = [F.expr(f"gammas[CAST(_h{k} & {DRAWS - 1}L AS INT)]").alias(f"_r{k}") for k in slots]
    b = [F.expr(f"((shiftright(_h{k}, 24) & 1048575L) / 1048576D)").alias(f"_b{k}") for k in slots]
    drawn = drawn.select(*more, *[f"_h{k}" for k in slots], *r, *b)
    code = (
        "IF(term IS NULL, NULL, logs[CAST(shiftright(_h{k}, 12) & {most}L AS INT)] - _r{k} *"
        " (IF(log_weight = 0D, 0D, floor(log_weight / _r{k} + _b{k})) - _b{k} + 1))"
    )
    return drawn.select(*keep, *[F.expr(code.format(k=k, most=DRAWS - 1)).alias(f"_s{k}") for k in slots])


def _words(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``text`` replaced by the array ``_w`` of its words."""
    rest = [c for c in df.columns if c != text]
    plain = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    df = df.select(*rest, F.split(plain, " +").alias("_w"))
    return df.withColumn("_w", F.filter("_w", lambda w: w != ""))


def weighted_terms(df: DataFrame, text: str) -> DataFrame:
    """One row per distinct word hash of ``text``: term and its count, null without words.

    Equal hashes lie together after sorting the array, so counts need no shuffle.
    """
    rest = [c for c in df.columns if c != text]
    hashes = F.sort_array(F.transform("_w", lambda w: F.xxhash64(w)))
    df = _words(df, text).select(*rest, hashes.alias("_h"))
    begins = F.expr(
        "filter(transform(_h, (x, i) -> IF(i > 0 AND _h[greatest(i - 1, 0)] = x, NULL, i)),"
        " x -> x IS NOT NULL)"
    )
    df = df.withColumn("_b", begins)
    runs = F.expr(
        "zip_with(_b, concat(slice(_b, 2, size(_b)), array(size(_h))),"
        " (a, e) -> IF(a IS NULL, NULL, struct(_h[a] AS term, e - a AS times)))"
    )
    runs = F.when(F.size("_h") > 0, runs)
    df = df.select(*rest, F.explode_outer(runs).alias("_r"))
    return df.select(*rest, F.col("_r.term").alias("term"), F.col("_r.times").alias("times"))


def signatures(
    df: DataFrame, text: str, samples: int = SAMPLES, carried: tuple[str, ...] = ()
) -> DataFrame:
    """``df`` with ``text`` replaced by ``signature``, an array of ``samples`` numbers.

    The columns besides ``text`` and ``carried`` must tell rows apart; ``carried`` are numbers
    that go along outside the grouping key. Text without words: all zeros.
    """
    rest = [c for c in df.columns if c != text]
    keys = [c for c in rest if c not in carried]
    quantiles = gamma_quantiles()
    groups = -(-samples // TOGETHER)
    spread = F.shiftleft(F.xxhash64("term", "_g"), TOGETHER.bit_length() - 1)
    terms = weighted_terms(df, text).select(
        *rest,
        "term",
        F.ln(F.col("times").cast("double")).alias("log_weight"),
        _table(quantiles).alias("gammas"),
        _table([math.log(q) for q in quantiles]).alias("logs"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_g"),
    )
    drawn = with_codes(terms.withColumn("_k", spread), [*rest, "_g"])
    codes = [f"_s{k}" for k in range(TOGETHER)]
    kept = [F.min(c).alias(c) for c in carried]
    found = drawn.groupBy(*keys, "_g").agg(*[F.min(c).alias(c) for c in codes], *kept)
    none = F.lit(0).cast("long")
    values = [F.when(F.col(c).isNull(), none).otherwise(F.xxhash64(c)) for c in codes]
    found = found.select(*rest, F.struct("_g", F.array(*values).alias("codes")).alias("_c"))
    whole = found.groupBy(*keys).agg(F.array_sort(F.collect_list("_c")).alias("_c"), *kept)
    signature = F.slice(F.flatten(F.col("_c.codes")), 1, samples)
    return whole.select(*rest, signature.alias("signature"))


def likeness(one: str, two: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples."""
    same = F.expr(f"size(filter(zip_with({one}, {two}, (x, y) -> x = y), e -> e))")
    return same.cast("double") / samples


def fingerprint_text(signature: str) -> Column:
    """16 bits of every sample in hex."""
    code = F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(0xFFFF))), 4, "0"))
    return F.array_join(code, "")


def _ranges(docs: DataFrame) -> list[float]:
    """Lower limits of the id ranges but the first; about RANGE_ROWS rows each."""
    rows = docs.count()
    count = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    if count == 1:
        return []
    shares = [k / count for k in range(1, count)]
    return sorted(set(docs.stat.approxQuantile("doc_id", shares, 0.25 / count)))


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    The edited text has the last floor(n / 2) code points replaced by the first as many
    (or all) of the next document in descending id order; after the last comes the first.
    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). Null texts are empty; texts without words have a fingerprint of zeros and
    are alike. Rows of one id follow each other by text; null ids come last, and without
    any id the last row's next text is empty. Ids must be numbers. Other columns are
    ignored; one row is its own next.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    limits = _ranges(own.select("doc_id"))
    part = F.lit(0)
    if limits:
        limits = ",".join(f"{x!r}D" for x in limits)
        part = F.size(F.expr(f"filter(array({limits}), e -> e <= doc_id)"))
        part = F.when(F.col("doc_id").isNull(), 0).otherwise(part)
    # the first row of a range follows the last row of the range above it
    tops = own.select("doc_id", part.alias("part")).groupBy("part").agg(F.max("doc_id").alias("top"))
    tops = sorted(tops.collect())  # one row per range: MOST_RANGES at most
    moves = [(low.top, high.part) for low, high in zip(tops, tops[1:])]
    moves += [(tops[-1].top, tops[0].part)] if tops else []
    moves = [m for m in moves if m[0] is not None]
    kind = f"top {own.schema['doc_id'].dataType.simpleString()}, target int"
    copies = F.broadcast(docs.sparkSession.createDataFrame(moves, kind))
    placed = own.withColumn("part", part).join(copies, F.col("doc_id") == F.col("top"), "left")
    both = F.explode(
        F.array_compact(
            F.array(
                F.struct(F.col("part"), F.lit(0).alias("copy")),
                F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("part"), F.lit(1).alias("copy"))),
            )
        )
    )
    placed = placed.select("doc_id", "text", both.alias("at")).select("doc_id", "text", "at.part", "at.copy")
    order = Window.partitionBy("part").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    rows = placed.select(
        "*", F.row_number().over(order).alias("row"),
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next"), F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited)
    # the digest goes along as four numbers, which aggregates keep in place
    digest = F.sha2("edited", 256)
    parts = [f"sha{k}" for k in range(4)]
    words = [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long") for k in range(4)]
    sides = F.explode(
        F.array_compact(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("text").alias("words"), *[F.lit(None).cast("long").alias(c) for c in parts]),
                F.when(
                    F.col("copy") == 0,
                    F.struct(F.lit(1).alias("side"), F.col("edited").alias("words"), *[w.alias(c) for w, c in zip(words, parts)]),
                ),
            )
        )
    )
    rows = rows.select("part", "row", "copy", "doc_id", "n_chars", sides.alias("s"))
    rows = rows.select("part", "row", "copy", "doc_id", "n_chars", "s.*")
    signed = signatures(rows, "words", samples, ("copy", "doc_id", "n_chars", *parts))
    sha = F.concat(*[F.lpad(F.lower(F.hex(c)), 16, "0") for c in parts])
    # of a document: its text, its edited text, then the next document's text
    follow = Window.partitionBy("part").orderBy("row", "side")
    out = signed.select(
        "doc_id", "n_chars", "copy", "side", "signature",
        F.lead(sha).over(follow).alias("edited_sha256"),
        F.lead("signature").over(follow).alias("edited"),
        F.coalesce(F.lead("signature", 2).over(follow), F.array_repeat(F.lit(0).cast("long"), samples)).alias("next"),
    ).where("side = 0 and copy = 0")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint_text("signature").alias("fingerprint"),
        fingerprint_text("edited").alias("edited_fingerprint"),
        likeness("signature", "edited", samples).alias("near_edited"),
        likeness("signature", "next", samples).alias("near_next"),
    )
