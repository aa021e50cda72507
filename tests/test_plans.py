"""Whole jobs on small made-up inputs, driven by settings files."""

import json
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmill.plans import behaviour, fraud, lending, mails, network, trending
from fieldmill.session import release_staged, scratch_path, staged
from fieldmill.sources.config import load_settings
from fieldmill.sources.readers import read_corpus, read_piped

LOG = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "ts", "uid", "id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p", "proto", "service",
        "duration", "orig_pkts", "conn_state", "label")]
)
NETWORK = {
    "numerical_features": ["duration", "orig_pkts"],
    "categorical_features": ["proto", "service", "conn_state"],
    "na_fill_vals": {"duration": -999999, "orig_pkts": -999999, "proto": "missing",
                     "service": "missing", "conn_state": "missing"},
    "windows": [
        {"name": "ip_last_min", "column": "source_ip", "minutes": 1},
        {"name": "ip_pkts", "column": "orig_pkts", "minutes": 30, "operation": "avg",
         "key": "source_ip"},
    ],
    "min_level_count": 5,
    "forest": {"numTrees": 3, "maxDepth": 3},
}


def log_lines(path, n=300):
    rng = random.Random(6)
    lines = ["|".join(f.name for f in LOG)]
    for i in range(n):
        bad = rng.random() < 0.4
        lines.append("|".join([
            f"{1_500_000_000 + 3 * i}.25", f"u{i}", f"h{rng.randrange(12)}", "80", "d", "53",
            "udp" if bad else "tcp", rng.choice(["-", "dns", "ssl"]),
            "-" if rng.random() < 0.3 else f"{rng.random():.3f}",
            str(rng.randrange(9) + 5 * bad), "S0", "Malicious" if bad else "Benign",
        ]))
    path.write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("random_split,row_id", [(True, None), (False, "uid")])
def test_network_job(spark, tmp_path, random_split, row_id):
    log_lines(tmp_path / "log.csv")
    saved = str(tmp_path / "model")
    config = {**NETWORK, "filepaths": [str(tmp_path / "log.csv")], "model_output_path": saved,
              "random_split": random_split, "row_id": row_id}
    (tmp_path / "c.json").write_text(json.dumps(config))
    s = load_settings(network.NetworkSettings, str(tmp_path / "c.json"))
    raw = read_piped(spark, s.filepaths, LOG)
    features, numeric, categorical = network.feature_table(raw, s)
    assert "conn_state" not in features.columns  # static
    assert numeric == ["duration", "orig_pkts", "ip_last_min", "ip_pkts"]
    assert categorical == ["proto", "service"]
    assert features.count() == 300
    assert features.where("duration is null or ip_pkts is null").count() == 0
    model, result = network.run(raw, s)
    assert 0.8 < result.first()["roc_auc"] <= 1
    assert len(PipelineModel.load(saved).stages) == len(model.stages)


def test_trending_job_keeps_one_row_per_video(spark):
    rng = random.Random(9)
    rows = [
        (f"v{rng.randrange(20)}", f"c{rng.randrange(3)}", f"18.{rng.randrange(1, 28):02d}.01",
         "2018-01-01T10:00:00.000Z", rng.randrange(3), rng.randrange(100), rng.randrange(3))
        for _ in range(120)
    ]
    df = spark.createDataFrame(
        rows, "video_id string, channel_title string, trending_date string, publish_time string, "
        "category_id int, likes int, dislikes int")
    categories = spark.createDataFrame([(0, "Film"), (1, "Music")], "id int, title string")
    s = trending.TrendingSettings(
        ratio_features={"ratio": ["likes", "dislikes"]},
        difference_features={"days_to_trending": ["trending_date", "publish_time"]},
        date_features={"trending_date": ["weekday"]},
        base_columns=["channel_title", "category_id", "ratio", "likes"],
        aggregate_windows=[7],
        date_column_format={"trending_date": "yy.dd.MM",
                            "publish_time": "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"},
    )
    out = trending.run(df, categories, s)
    assert out.count() == df.select("video_id").distinct().count()
    assert {r["category_id"] for r in out.collect()} <= {"Film", "Music", None}
    assert out.where("general_num_trending_videos_last_7_days < "
                     "channel_num_trending_videos_last_7_days").count() == 0


def test_fraud_job(spark):
    rng = random.Random(1)
    rows = [(m, None if rng.random() < 0.2 else x, rng.choice(["a", "b", None]), 7, int(x > 0.7), None)
            for m in range(8) for x in [rng.random() for _ in range(60)]]
    df = spark.createDataFrame(
        rows, "month int, x double, kind string, fixed int, fraud_bool int, gone double")
    s = fraud.FraudSettings(["x", "fixed", "gone"], ["kind"], booster={"maxIter": 3, "maxDepth": 2})
    prepared = fraud.prepared(df, s)
    assert set(prepared.columns) == {"month", "x", "kind", "fraud_bool", "split"}
    assert prepared.where("x is null or kind is null").count() == 0
    _, metrics = fraud.run(df, s)
    row = metrics.first()
    assert row["roc_auc"] > 0.7 and 0 < row["average_precision"] <= 1


def test_mail_job(spark, tmp_path):
    body = "apple pear fruit juice" 
    other = "engine wheel motor road"
    text = "From r  ".join(
        ["", *[f"From: a{i}@b.c\nSubject: s\nStatus: O\n{body if i % 2 else other} <b>x</b> {i}\n"
               for i in range(20)]])
    (tmp_path / "mails.txt").write_text(text)
    corpus = read_corpus(spark, str(tmp_path / "mails.txt"))
    prepared = mails.prepared(corpus, ["road"])
    assert prepared.count() == 21  # the piece before the first mark has no body
    assert prepared.where("email_text is null and clean_text_tokenised is null").count() == 1
    words = {w for r in prepared.collect() for w in r["clean_text_tokenised"] or []}
    assert words == {"apple", "pear", "fruit", "juice", "engine", "wheel", "motor"}
    terms = mails.clusters(prepared, k=2, terms=3).collect()
    assert {r["cluster"] for r in terms} == {0, 1} and max(r["rank"] for r in terms) == 3


def test_behaviour_job(spark):
    rng = random.Random(4)
    calls, links = [], []
    for g in range(120):
        odd = g % 3 == 0
        calls.append((f"g{g}", None if g == 5 else 1.0, "outlier" if odd else "normal"))
        links += [(f"g{g}", rng.randrange(9), rng.randrange(9)) for _ in range(3 if odd else 12)]
    calls = spark.createDataFrame(calls, "_id string, `gap(sec)` double, classification string")
    links = spark.createDataFrame(links, "_id string, `from` int, `to` int")
    table = behaviour.feature_table(behaviour.cleaned_calls(calls, "gap(sec)"), links)
    assert table.count() == 119
    report = behaviour.run(table, ["n_connections", "n_unique_nodes"], 0.5, maxIter=3, maxDepth=2)
    assert report.best.first()["f1"] == 1.0
    assert report.false_positives.count() == report.false_negatives.count() == 0
    best = {r["threshold"]: r["f1"] for r in report.rule.collect()}
    assert best[3] == 1.0 and best[12] < 1


def test_boosters_of_the_jobs_stop_by_validation(spark):
    from fieldmill.catalog import jobs

    assert jobs.ROUNDS == jobs._FRAUD.booster["maxIter"] == 200
    rng = random.Random(8)
    rows = [(f"g{g}", rng.randrange(9), rng.random() < 0.4) for g in range(300)]
    table = spark.createDataFrame(rows, "_id string, n_connections int, is_anomaly boolean")
    report = behaviour.run(table, ["n_connections"], 0.5, maxIter=jobs.ROUNDS, maxDepth=3)
    assert 1 <= report.model.stages[-1].getNumTrees < jobs.ROUNDS


def test_lending_job(spark):
    rows = [("x" if i % 2 else None, "Rare" if i == 0 else "City", "Y" if i % 3 else "0",
             "$1,000.50 ", "NY", "NY" if i % 2 else None, 2.0 if i % 5 == 0 else None,
             501, 441110, "1976A" if i == 1 else str(1990 + i % 20)) for i in range(300)]
    df = spark.createDataFrame(
        rows, "ChgOffDate string, City string, RevLineCr string, GrAppv string, State string, "
        "BankState string, NewExist double, Zip int, NAICS int, ApprovalFY string")
    places = spark.createDataFrame([("00501", -73.0, 40.0)],
                                   "code string, longitude double, latitude double")
    s = lending.LendingSettings(rare_columns=["City"], flag_columns=["RevLineCr"],
                                money_columns=["GrAppv"])
    out = lending.run(df, places, s).collect()
    assert len(out) == 299 and {r["naics_first_two"] for r in out} == {"44"}
    assert {r["City"] for r in out} == {"City", "Other"}
    assert {r["GrAppv"] for r in out} == {100050.0}
    assert {r["same_state"] for r in out} == {True, False}
    assert {r["longitude"] for r in out} == {-73.0}
    assert {r["split"] for r in out} == {"train", "val", "test"}


def test_staged_tables_can_be_released(spark):
    release_staged(spark)
    df = staged(spark.range(3).withColumn("x", F.lit("a")))
    assert df.count() == 3
    assert release_staged(spark) == 1 and release_staged(spark) == 0
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
