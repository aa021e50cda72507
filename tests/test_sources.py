import json
import random
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmill.operators.graph import (
    _weighted_statistics,
    degree_features,
    degrees,
    graph_features,
    graph_sizes,
)
from fieldmill.operators.joins import (
    coordinates,
    join_original_features,
    key_overlap,
    mapped,
    mapped_from_dict,
    one_row_per_key,
)
from fieldmill.plans import trending
from fieldmill.sources.config import load_settings, resolved, save_settings
from fieldmill.sources.readers import read_categories, read_corpus, read_piped, read_quoted
from fieldmill.sources.writers import write_columnar, write_delimited


def test_piped_files(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"{i}.csv").write_text(f"ts|id.orig_h|label\n{i}.5|h{i}|Benign\n")
    schema = T.StructType(
        [T.StructField("ts", T.DoubleType()), T.StructField("id.orig_h", T.StringType()),
         T.StructField("label", T.StringType())]
    )
    df = read_piped(spark, [str(tmp_path / f"{i}.csv") for i in range(2)], schema)
    assert sorted(tuple(r) for r in df.collect()) == [(0.5, "h0", "Benign"), (1.5, "h1", "Benign")]


def test_quoted_text_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", you'), (2, "two\nlines"), (3, "plain")]
    df = spark.createDataFrame(rows, "id int, t string")
    write_delimited(df, str(tmp_path / "q"))
    back = read_quoted(spark, str(tmp_path / "q"), df.schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_categories(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"kind": "x", "items": [
        {"id": "1", "snippet": {"title": "Film"}}, {"id": "7", "snippet": {"title": "Music"}}]}, indent=1))
    assert {tuple(r) for r in read_categories(spark, str(path)).collect()} == {(1, "Film"), (7, "Music")}


def test_corpus(spark, tmp_path):
    path = tmp_path / "mails.txt"
    path.write_text("From r  one\nline\nFrom r  two\n")
    got = [r["emails"] for r in read_corpus(spark, str(path)).collect()]
    assert [g for g in got if g] == ["one\nline\n", "two\n"]


def test_columnar_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    for _ in range(2):  # the second write replaces the first
        back = write_columnar(df, str(tmp_path / "t"), ["p"])
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]


@dataclass
class Settings:
    columns: list
    rounds: int = 0


def test_settings(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text("columns: [a, b]\nrounds: 3\n")
    assert load_settings(Settings, str(tmp_path / "s.yaml")) == Settings(["a", "b"], 3)
    (tmp_path / "s.json").write_text('{"columns": [], "odd": 1}')
    with pytest.raises(ValueError, match="odd"):
        load_settings(Settings, str(tmp_path / "s.json"))


def test_nested_settings(spark, tmp_path):
    tables, features = {"rows": "r"}, {
        "ratio_features": {"a_to_b": ["a", "b"]},
        "difference_features": {"days_to_trending": ["trending_date", "start"]},
        "date_features": {"trending_date": ["weekday"]},
        "base_columns": ["a", "a_to_b", "trending_date_weekday"],
        "aggregate_windows": [7, 30],
    }
    job = resolved(trending.TrendingJob, {"tables": tables, "features": features})
    assert job.tables.format == "parquet" and job.features.max_time_to_trending == 60
    save_settings(job, str(tmp_path / "job.json"))
    assert load_settings(trending.TrendingJob, str(tmp_path / "job.json")) == job
    for raw, words in (
        ({"tables": {"rows": "r", "odd": 1}, "features": features}, "tables.odd"),
        ({"tables": {}, "features": features}, "tables.rows"),
        ({"tables": "r", "features": features}, "tables"),
    ):
        with pytest.raises(ValueError, match=words):
            resolved(trending.TrendingJob, raw)
    columns = ["a", "b", "trending_date", "start", "video_id", "channel_title"]
    trending.check_settings(job.features, columns)
    with pytest.raises(ValueError, match="b .ratio_features"):
        trending.check_settings(job.features, [c for c in columns if c != "b"])
    job.features.base_columns.append("nowhere")
    with pytest.raises(ValueError, match="nowhere .base_columns"):
        trending.check_settings(job.features, columns)


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id int, title string")
    got = {r["v"]: r["k"] for r in mapped(df, "k", dim, "id", "title").collect()}
    assert got == {"a": "one", "b": None, "c": None}
    got = {r["v"]: r["k"] for r in mapped_from_dict(df, "k", {1: "one"}).collect()}
    assert got == {"a": "one", "b": None, "c": None}
    places = spark.createDataFrame([("00501", -73.0, 40.8)], "code string, lon double, lat double")
    zips = spark.createDataFrame([(501,), (99999,)], "zip int")
    out = coordinates(zips, "zip", places, "code", "lon", "lat")
    assert {tuple(r) for r in out.collect()} == {(501, -73.0, 40.8), (99999, None, None)}


def test_key_overlap_ignores_nothing_but_null_matches(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "a string")
    b = spark.createDataFrame([("y",), (None,), ("z",)], "b string")
    assert tuple(key_overlap(a, "a", b, "b").first()) == (3, 3, 1)


def test_one_row_per_key_and_original_features(spark):
    rows = spark.createDataFrame(
        [(1, "2020-01-01", 5), (1, "2020-01-01", 3), (1, "2020-01-02", 1)], "id int, d string, v int"
    )
    first = one_row_per_key(rows, ["id", "d"], ["v"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, "2020-01-01", 3), (1, "2020-01-02", 1)]
    main = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-01")], "id int, first string")
    out = join_original_features(main, rows, ["id", "first"], ["id", "d"], ["v"])
    assert {tuple(r) for r in out.collect()} == {(1, "2020-01-01", 3), (2, "2020-01-01", None)}


def test_graphs(spark):
    rows = [("one", 1, 2), ("loop", 3, 3), ("many", 1, 2), ("many", 1, 2), ("many", 2, 4)]
    edges = spark.createDataFrame(rows, "_id string, `from` int, `to` int")
    sizes = {r["_id"]: (r["n_connections"], r["n_unique_nodes"]) for r in graph_sizes(edges).collect()}
    assert sizes == {"one": (1, 2), "loop": (1, 1), "many": (3, 3)}
    full = {r["_id"]: r for r in graph_features(edges, featured=degrees(edges)).collect()}
    assert full["one"]["std_global_source_degrees"] is None
    assert full["many"]["max_local_source_degrees"] == 2
    assert full["many"]["avg_global_source_degrees"] == pytest.approx((3 + 3 + 1) / 3)
    assert graph_features(edges, []).columns == ["_id", "n_connections", "n_unique_nodes"]


def test_degrees_keep_edges_without_an_end(spark):
    edges = spark.createDataFrame(
        [("g", "a", "b"), ("g", "a", None), (None, None, "b")], "_id string, from string, to string"
    )
    got = {(r["_id"], r["from"], r["to"]): r for r in degrees(edges).collect()}
    assert len(got) == 3
    assert got["g", "a", None]["global_source_degrees"] == 2
    assert got["g", "a", "b"]["global_dest_degrees"] == 2
    assert got["g", "a", "b"]["local_dest_degrees"] == 1


def test_degree_features_equal_those_of_every_edge(spark):
    """Hot nodes, loops, repeated edges, missing ends and graphs."""
    draw = random.Random(4)
    rows = [(f"g{draw.randrange(12)}", draw.choice([0, 0, 0, *range(20)]), draw.choice([0, *range(30)])) for _ in range(600)]
    rows += [("one", 1, 2), ("loop", 3, 3), ("half", 1, None), ("half", None, None), (None, 0, 1), (None, None, 2)]
    edges = spark.createDataFrame(rows, "_id string, `from` int, `to` int").repartition(3)
    want = {r["_id"]: r for r in graph_features(edges, featured=degrees(edges)).collect()}
    got = {r["_id"]: r for r in degree_features(edges).collect()}
    assert set(got) == set(want) and None not in got
    for key, row in want.items():
        assert got[key].asDict() == pytest.approx(row.asDict())
    plan = degree_features(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    assert degree_features(edges.limit(0)).count() == 0


def test_deviation_of_large_degrees(spark):
    sized = spark.createDataFrame([("g", 10**12, 3), ("g", 10**12 + 1, 1)], "_id string, d long, n long")
    got = sized.groupBy("_id").agg(*_weighted_statistics(F.col("d"), F.col("n"), "d")).first()
    assert got["std_d"] == pytest.approx(0.5) and got["min_d"] == 10**12


def test_degree_features_shuffle_narrow_rows_and_share_the_counts(spark):
    """Wide sums only move once added up per graph; the counts are the same in both uses."""
    edges = spark.createDataFrame([("g", 1, 2), (None, 1, 3)], "_id string, `from` int, `to` int").repartition(2)
    plan = degree_features(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert plan.count("Repartition") >= 4 and "isnotnull(_id" not in plan
    assert [r["_id"] for r in degree_features(edges).collect()] == ["g"]
