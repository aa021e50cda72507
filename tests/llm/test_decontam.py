import random
import re

from fieldmill.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = {}
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            want = words(passage)
            width = min(10, len(want))
            grams = {tuple(want[k : k + width]) for k in range(len(want) - width + 1)} if want else set()
            for k in range(len(own) - width + 1):
                if tuple(own[k : k + width]) in grams:
                    hit.update(range(k, k + width))
                    found.add(str(item))
        out[key] = (len(own), sorted(hit), sorted(found))
    return out


def tables(spark):
    draw = random.Random(4)
    items = [(k, " ".join(f"t{draw.randrange(50)}" for _ in range(draw.choice([1, 4, 10, 25])))) for k in range(12)]
    items += [(12, None), (13, "!!"), (3, items[3][1])]
    docs = []
    for key in range(60):
        parts = [f"T{draw.randrange(60)}" for _ in range(draw.choice([0, 3, 40]))]
        if draw.random() < 0.6:
            passage = draw.choice(items)[1] or ""
            cut = passage.split(" ")[draw.randrange(3) :]
            parts[len(parts) // 2 : len(parts) // 2] = cut
        docs.append((key, "Été, " + draw.choice([" ", "-", "\n"]).join(parts) if parts else None))
    return docs, items


def test_both_ways_equal_brute_force(spark):
    docs, items = tables(spark)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontam.SET_LIMIT, 0):
        got = decontam.contamination(frame, bench, set_limit=limit).collect()
        assert {r.doc_id: (r.n_words, r.hit, r.items) for r in got} == brute(docs, items)


def test_spans_and_documents_go(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    rows = [(1, "Intro. A b c-d e f g h i j k! Rest"), (2, "a b c d e f g h i"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontam.remove_spans(docs, bench).collect()}
    assert cut == {1: "Intro. Rest", 2: "a b c d e f g h i", 3: None}


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(None, "sat on the mat"), (2, "")], "item_id long, text string")
    got = decontam.contamination(odd, bench).collect()
    assert len(got) == odd.count()
    assert {r.doc_id for r in got if r.contaminated} == {6, 7}
    assert all(r["items"] == ["null"] for r in got if r.contaminated)
    assert decontam.contamination(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(odd, bench.limit(0)).collect())
    assert decontam.drop_contaminated(odd, bench).columns == odd.columns
