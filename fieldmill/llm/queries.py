"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, decontam, fingerprint, langid, neardup, ngramjoin, packing, periodic
from . import quality, sharding, toxicity, webpages
from .common import fold


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    text = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    found = chat.windows(rows.unionByName(probe))
    read = found.select(
        "conv_id",
        "window",
        chat.read_turns(F.col("formatted"), F.col("n_repeated")).alias("turns"),
        chat.read_targets(F.col("formatted"), F.col("spans")).alias("targets"),
        F.char_length("formatted").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
        F.count("window").alias("n_windows"),
    )
    whole = whole.withColumn("turns", F.flatten("w.turns")).withColumn(
        "loss", F.array_join(F.flatten("w.targets"), "")
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = webpages.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), 40)


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = quality.train(docs, table(spark, folder, "labels"), ~held_out)
    return quality.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, folder, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    models = langid.train(docs.where(~held_out))
    found = langid.identify(docs, models)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "loss", "rejected"
    )


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), width=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngramjoin.ngram_join(table(spark, folder, "documents")).drop("text_hash")


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    edited = docs.select(
        "doc_id", periodic.with_planted_period(F.col("text"), F.col("doc_id")).alias("text")
    )
    found = periodic.periodic_runs(edited).withColumn("best", periodic.strongest("runs"))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_toxicity": op4_toxicity,
    "op5_jump_sharding": op5_jump_sharding,
    "op6_language_id": op6_language_id,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op5_jump_sharding": r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t FROM documents
), bytes AS (
    SELECT doc_id, octet_length(encode(t)) AS n, string_split(hex(encode(t)), '') AS h FROM docs
), halves AS (  -- low half of every byte before its high half
    SELECT doc_id, n, flatten([[strpos('0123456789ABCDEF', h[2 * i]) - 1,
        strpos('0123456789ABCDEF', h[2 * i - 1]) - 1] FOR i IN range(1, n + 1)]) AS v
    FROM bytes
), sums AS (  -- fixed values: the CRC-32 of all 16 halves
    SELECT doc_id, n + 16 AS size, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), CAST(v AS BIGINT[])),
        lambda c, b: xor(c >> 4, CAST([0, 498536548, 997073096, 651767980, 1994146192, 1802195444,
            1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920,
            2262029012, 2685067896, 3183342108][CAST(1 + (xor(c, b) & 15) AS INTEGER)] AS BIGINT))
        ), 4294967295) AS text_crc32
    FROM halves
), jumps AS (
    SELECT doc_id, [list_reduce(
        list_prepend({'k': CAST(doc_id AS HUGEINT), 'b': CAST(-1 AS BIGINT), 'j': CAST(0 AS BIGINT)},
            [{'k': CAST(0 AS HUGEINT), 'b': CAST(0 AS BIGINT), 'j': CAST(0 AS BIGINT)} FOR x IN range(41)]),
        lambda s, x: CASE WHEN s.j >= n THEN s ELSE {
            'k': (s.k * 2862933555777941757 + 1) % 18446744073709551616,
            'b': s.j,
            'j': CAST(floor((s.j + 1) * (CAST(2147483648 AS DOUBLE) / CAST(
                ((s.k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
        } END).b FOR n IN [40, 41]] AS b,
        ((CAST(doc_id AS HUGEINT) * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 % 1024 AS block
    FROM docs
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(b[1] AS INTEGER) AS shard,
       CAST(b[2] AS INTEGER) AS grown_shard,
       row_number() OVER (PARTITION BY b[1] ORDER BY block, doc_id) - 1 AS slot
FROM sums JOIN jumps USING (doc_id)
""",
    "op7_benchmark_decontamination": r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS width,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM items WHERE len(w) > 0)
), spots AS (
    SELECT doc_id, i, width, array_to_string(w[i:i + width - 1], ' ') AS g
    FROM (SELECT d.doc_id, d.w, x.width, unnest(range(1, len(d.w) - x.width + 2)) AS i
          FROM docs d, (SELECT DISTINCT width FROM grams) x)
), hits AS (
    SELECT s.doc_id, s.i, s.width, g.item_id
    FROM spots s JOIN grams g ON s.g = g.g
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
""",
    "op10_minhash_near_dedup": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)])
        END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), tops AS (
    SELECT x, min(y) AS top FROM reach GROUP BY x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, t.top AS component_id,
       s.doc_id = t.top AS kept
FROM sets s JOIN tops t ON s.doc_id = t.x
""",
    "op11_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
        END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id
FROM sets s JOIN least l ON s.doc_id = l.x
""",
    "op12_filter_audit": r"""
WITH known AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
    FROM labels GROUP BY doc_id
), words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
                  CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
                  CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t)
                       THEN 'C' ELSE '' END,
                  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                  CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
    FROM words LEFT JOIN known USING (doc_id)
), kinds AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), hits AS (
    SELECT part, filter_order, step, f, n, good, toxic, fails,
           contains(fails, f) AS own, length(translate(fails, before, '')) < length(fails) AS gone
    FROM kinds, steps
), sums AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN NOT own AND NOT gone THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN own AND NOT gone THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN own AND gone THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN own AND NOT gone THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN own AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
    FROM hits GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM sums
""",
    "op13_periodic_runs": r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           string_split(hex(encode(CAST(doc_id AS VARCHAR))), '') AS x
    FROM documents
), hashed AS (  -- fixed values: the CRC-32 of all 16 halves; low half of a byte first
    SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), CAST(flatten([[strpos('0123456789ABCDEF', x[2 * i]) - 1,
            strpos('0123456789ABCDEF', x[2 * i - 1]) - 1] FOR i IN range(1, len(x) // 2 + 1)]) AS BIGINT[])),
        lambda c, b: xor(c >> 4, CAST([0, 498536548, 997073096, 651767980, 1994146192, 1802195444,
            1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920,
            2262029012, 2685067896, 3183342108][CAST(1 + (xor(c, b) & 15) AS INTEGER)] AS BIGINT))
        ), 4294967295) AS h
    FROM words
), spread AS (
    SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS edit, (h // 10) % greatest(n, 1) AS a,
           1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p,
           unnest(range(0, n)) AS i
    FROM hashed
), edited AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN edit AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM spread
), pairs AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i AS i
    FROM edited x JOIN edited y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pairs
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM islands GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (  -- a power of a root is the same stretch with a larger period
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), lists AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
           list({'s': start, 'l': length, 'p': period}
                ORDER BY CAST(length AS DOUBLE) / period DESC, start, period)[1] AS best
    FROM runs GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS t
    FROM edited e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT d.doc_id, CAST(coalesce(l.n_runs, 0) AS BIGINT) AS n_runs, CAST(l.best.s AS BIGINT) AS start,
       CAST(l.best.l AS BIGINT) AS length, CAST(l.best.p AS BIGINT) AS period,
       CAST(1000 * l.best.l // l.best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(c.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN lists l ON d.doc_id = l.doc_id LEFT JOIN collapsed c ON d.doc_id = c.doc_id
""",
}
