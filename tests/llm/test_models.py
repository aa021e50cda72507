import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmill.llm import langid, quality, toxicity, webpages

FOLDER = "/root/testdata/sf0.1"


def text_of(draw, letters, count=60):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(1, 7))) for _ in range(count))


def test_kneser_ney_equals_a_plain_model():
    draw = random.Random(2)
    texts = [text_of(draw, "abcd") for _ in range(30)]
    keys, first, _ = langid.char_keys(texts)
    own, counts = np.unique(keys, return_counts=True)
    model = langid.build_models(["x"], [own.astype(np.int64)], [counts])

    def grams(text):
        codes = [0, 0, 0] + [ord(c) - 96 if c.isalpha() else 0 for c in text] + [0]
        return [tuple(codes[k - 3 : k + 1]) for k in range(3, len(codes))]

    four = {}
    for text in texts:
        for g in grams(text):
            four[g] = four.get(g, 0) + 1

    def discount(table):
        one, two = (sum(v == n for v in table.values()) for n in (1, 2))
        return one / (one + 2 * two) if one and two else 0.5

    def shorter(table):
        out = {}
        for g in table:
            out[g[1:]] = out.get(g[1:], 0) + 1
        return out

    def chance(g, orders):
        if not orders:
            return 1 / langid.CLASSES
        table, below = orders[0], chance(g[1:], orders[1:])
        same = {h: v for h, v in table.items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return below
        cut = discount(table)
        return (max(table.get(g, 0) - cut, 0) + cut * len(same) * below) / total

    three = shorter(four)
    two = shorter(three)
    orders = [four, three, two, shorter(two)]
    for text in [texts[0], "abba dada", "zzz abc", "a"]:
        keys, first, _ = langid.char_keys([text])
        want = -sum(math.log(chance(g, orders)) for g in grams(text)) / len(grams(text))
        assert abs(model.losses(keys, first)[0][0, 0] - want) < 1e-4


def test_languages_and_rejection(spark, odd, empty):
    draw = random.Random(5)
    rows = [(k, text_of(draw, "etaoin" if k % 2 else "ñuyzxk", draw.randint(2, 80)), "ab"[k % 2]) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.train(docs.where("doc_id < 300"))
    got = langid.identify(docs, models).toPandas()
    assert (got["lang_pred"] == ["ab"[k % 2] for k in got["doc_id"]]).all()
    assert not got["rejected"].any() and got["score"].between(0, 1).all()
    strange = spark.createDataFrame([(1, "qwpqwp ghjghj bvmbvm " * 30)], "doc_id long, text string")
    assert langid.identify(strange, models).first().rejected
    found = {r.doc_id: r for r in langid.identify(odd, models).collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 3, 4))
    kept = langid.keep_identified(odd, models)
    assert kept.columns == odd.columns and {1, 2, 3, 4}.isdisjoint(r.doc_id for r in kept.collect())
    nothing = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_random_indexing_sums_equal_a_plain_count(spark):
    texts = ["a b c a b", "c ## b", None, "a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    places, signs = quality.index_vectors()
    import pyarrow as pa

    want = np.zeros((quality.WORDS, quality.DIMS))
    for text in texts:
        words, _ = quality.hashed_words(pa.array([text], pa.string()))
        for i in range(len(words)):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(want[words[i]], places[words[j]], signs)
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1)
    assert np.allclose(quality.word_vectors(frame), want, atol=1e-6)


def test_slices_leave_their_task_as_unit_vectors():
    import pyarrow as pa

    draw = np.random.Generator(np.random.PCG64(8))
    sums = draw.integers(-9, 9, (2, quality.WORDS // quality.SLICES, quality.DIMS))
    sums[:, 5] = 0
    cells = [b"i" + zlib.compress(part.astype(np.int32).tobytes()) for part in sums]
    batch = pa.RecordBatch.from_pydict({"slice": [3, 3], "cells": cells})
    (got,) = quality._unit_vectors(iter([batch]))
    kept = np.frombuffer(got.column("cells")[0].as_buffer(), np.float32).reshape(sums[0].shape)
    want = sums.sum(axis=0) / np.maximum(np.linalg.norm(sums.sum(axis=0), axis=1, keepdims=True), 1)
    assert got.column("slice").to_pylist() == [3] and np.array_equal(kept, want.astype(np.float32))


def test_pooling_in_pieces(monkeypatch):
    draw = np.random.Generator(np.random.PCG64(3))
    vectors = draw.normal(size=(50, quality.DIMS)).astype(np.float32)
    words, first = draw.integers(0, 50, 700), np.array([0, 0, 300, 301, 301, 700])
    whole = quality.pooled(words, first, vectors)
    monkeypatch.setattr(quality, "POOL_CHUNK", 64)
    assert np.allclose(quality.pooled(words, first, vectors), whole, atol=1e-5)
    part = vectors[words[:300]].astype(float)
    d = quality.DIMS
    assert np.allclose(whole[1, :d], part.mean(axis=0), atol=1e-5)
    assert np.allclose(whole[1, 2 * d : 3 * d], (part[:-1] * part[1:]).sum(axis=0) / 299, atol=1e-4)
    assert not whole[0].any() and not whole[3].any()


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_held_out_accuracy_and_odd_rows(spark, odd, empty, which):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 3 < 2")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    module, least = (quality, 0.97) if which == "quality" else (toxicity, 0.97)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = module.train(docs, labels, ~held)
    got = module.score(docs.where(held), model).join(labels, "doc_id")
    right = got.agg(F.avg(((F.col("score") >= 0.5) == (F.col(which) == 1)).cast("int"))).first()[0]
    assert right > least
    strange = module.score(odd, model).collect()
    assert len(strange) == odd.count() and all(0 <= r.score <= 1 for r in strange)
    assert module.score(empty, model).count() == 0
    none = module.train(odd, labels.limit(0))
    assert {r.score for r in module.score(odd, none).collect()} == {0.5}
    if which == "toxic":
        other = toxicity.train(docs, labels, ~held, broadcast_rows=0)
        assert np.allclose(other.words.gain, model.words.gain)
    else:
        assert quality.keep_good(odd, model, 0.0).columns == odd.columns


def page(body, k=0):
    return (
        f"<html><head><title>t</title></head><body><div class='top'><p>Site name</p></div><div><p>Buy {k}</p></div>"
        f"{body}<div class='x'><span>All rights reserved</span></div></body></html>"
    )


def test_template_text_goes_and_slots_stay(spark):
    rows = [(k, "http://h.org/a", page(f"<div><p>Story {k}</p><p>More of {k}</p></div>", k)) for k in range(20)]
    rows += [(90, "http://small.org/", page("<p>alone</p>")), (91, None, None), (92, "x", ""), (90, "http://small.org/", page("<p>alone</p>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = webpages.extract(pages)
    assert got.count() == len(rows)
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[3] == "Buy 3 Story 3 More of 3"
    assert texts[90] == "Site name Buy 0 alone All rights reserved" and texts[91] == "" and texts[92] == ""
    assert webpages.extract(pages.limit(0)).count() == 0


def test_main_text_of_marked_up_pages():
    source = (
        "<body><header>Head</header><div class=cookie-notice>We use</div><aside>side</aside><article><header><h1>Title</h1></header>"
        "<p>One <b>bo</b>ld &amp; two<br>three<p>Four<ul><li>a<li>b</ul><form><p>mail</form>"
        "<div id='comments'><p>nice</div></article><footer>f</footer><script>if(a<b){}</script>"
    )
    assert webpages.main_text(source, frozenset()) == "Title One bold & two three Four a b"
    assert webpages.main_text("a &lt;b&gt; < 3", frozenset()) == "a <b> < 3"


def test_classes_decide_inside_articles(spark):
    def blog(k, extra=""):
        return (
            f"<body><article><h1>Title {k}</h1><div class='by'>By the staff</div><p>Story {k}</p>"
            + "".join(f"<p class='note'>Note</p><p>Part {k} {j}</p>" for j in range(k % 3 + 1))
            + f"{extra}</article><div><article class='teaser{k}'>Teaser {k}</article></div></body>"
        )

    rows = [(k, f"http://b.org/{k}", blog(k, "<p>Said often</p>" if k % 3 else "")) for k in range(12)]
    rows += [(50 + k, f"http://same.org/{k}", blog(7)) for k in range(8)]
    rows += [(90, "http://few.org/", blog(4))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    texts = {r.page_id: r.text for r in webpages.extract(pages).collect()}
    # once-a-page and repeated classes go, text without tags of its own and the teaser's place do not count
    assert texts[3] == "Title 3 Story 3 Part 3 0"
    assert texts[4] == "Title 4 Story 4 Part 4 0 Part 4 1 Said often"
    assert texts[90] == "Title 4 By the staff Story 4 Note Part 4 0 Note Part 4 1 Said often Teaser 4".replace(" Said often", "")
    assert "By the staff" in texts[50]  # copies of one page make no template
    for doubled in (pages.unionByName(pages), pages.unionByName(pages).unionByName(pages)):
        again = webpages.extract(doubled).select("page_id", "text").distinct().collect()
        assert {r.page_id: r.text for r in again} == texts and len(again) == len(texts)

    frame = webpages.pd.concat(
        b.to_pandas()
        for b in webpages._occurrences(iter([webpages.pa.RecordBatch.from_pydict(
            {"host": ["h"] * 12, "page": list(range(12)), "html": [r[2] for r in rows[:12]]}
        )]))
    )
    frame = frame[frame["pages"] >= 6]
    whole = frozenset(webpages.valid_tokens(frame))
    assert webpages.main_text(rows[3][2], whole) == texts[3]
    lost = frame[frame["depth"] == 0].index  # other vectors: the texts leave the classes of their tags
    other = frame.assign(vector=frame["vector"].where(~frame.index.isin(lost), frame["vector"] + 1))
    assert "By the staff" in webpages.main_text(rows[3][2], frozenset(webpages.valid_tokens(other)))
    assert "Note" in webpages.main_text(rows[3][2], frozenset(webpages.valid_tokens(other)))
    bare = frame[frame["depth"] == 0]
    assert webpages.valid_tokens(bare) == []
    tag = webpages._key("/body/article")
    assert "Teaser 3" in webpages.main_text(rows[3][2], whole - {tag})


def test_language_range_comes_from_all_rows(spark):
    from fieldmill.llm import langid

    draw = np.random.default_rng(8)
    words = {"xx": ["alba", "berto", "calma", "dorma"], "yy": ["krumt", "stelz", "wirft", "zwolk"]}
    rows = [
        (lang, " ".join(draw.choice(words[lang] + ["q" * int(draw.integers(1, 9))], int(draw.integers(1, 12)))))
        for lang in words
        for _ in range(9000)
    ]
    models = langid.train(spark.createDataFrame(rows, "lang string, text string"))
    keys, first, _ = langid.char_keys([t for _, t in rows])
    loss, sizes = models.losses(keys, first)
    own = np.array([models.langs.index(x) for x, _ in rows])
    far = np.zeros(len(rows))
    for n in range(2):
        values, length = loss[own == n, n], sizes[own == n]
        gap = (values - np.median(values)) ** 2
        assert models.centre[n] == pytest.approx(np.median(values), rel=1e-12)
        assert models.inner[n] == pytest.approx(np.median(gap * length) / 0.455 + 1e-6, rel=1e-9)
        assert models.outer[n] == pytest.approx(np.median(gap) / 0.455 + 1e-9, rel=1e-9)
        far[own == n] = (values - models.centre[n]) / np.sqrt(models.inner[n] / length + models.outer[n])
    assert models.limit == pytest.approx(2 * np.quantile(far, 0.999), rel=1e-9)
    gaps = -(loss - loss.min(axis=1, keepdims=True)) * sizes[:, None]
    costs = [np.log(np.exp(gaps / h).sum(axis=1)).mean() - (gaps[np.arange(len(own)), own] / h).mean() for h in langid.HEATS]
    assert models.heat == langid.HEATS[int(np.argmin(costs))]
