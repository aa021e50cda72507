"""Model fitting, scoring, search and sweeps.

Texts are labelled for quality, which their measures can tell. A fitted score has no SQL
form, so the queries return facts about it that any engine can state: rows scored, better
than a constant guess, equal after reload, best of all trials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import portable_hash
from ..functions.text import cleaned, kept_tokens
from ..learn import model as M
from ..learn import trees as R
from ..learn import tune as N
from ..learn.evaluate import ranking_metrics
from ..learn.power import class_counts, predictive_powers
from ..session import scratch_path, staged
from .base import Tables, register
from .scalars import STOPWORDS

LEARNER_PARTS = 8
NUMERIC = ["n_chars", "letters", "capitals", "symbols", "distinct"]
CATEGORICAL = ["lang"]
TREES, ROUNDS, PATIENT_ROUNDS = 100, 200, 100
_ROWS_SQL = """labelled AS (SELECT doc_id, quality,
  CAST('0x' || substr(md5('model:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 AS draw
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"""
_GOOD_SQL = f"WITH {_ROWS_SQL} SELECT count(*) AS rows, true AS above_constant FROM labelled WHERE draw >= 8"


def _labelled(t: Tables) -> DataFrame:
    """Labelled texts with measures, a class and a number to predict.

    Partitions and their order follow from the row ids, so that fitted results do not
    depend on the cluster.
    """
    size = F.greatest(F.char_length("text"), F.lit(1))
    words = F.split("text", " ")

    def share(pattern: str):
        return F.char_length(F.regexp_replace("text", pattern, "")) / size

    draw = F.pmod(portable_hash("doc_id", "model:"), F.lit(10))
    texts = t.documents.select(
        "doc_id",
        "lang",
        F.char_length("text").alias("n_chars"),
        share(r"\P{L}").alias("letters"),
        share(r"\P{Lu}").alias("capitals"),
        share(r"[\p{L}\p{N}\s]").alias("symbols"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct"),
        F.size(words).cast("double").alias("n_words"),
        (draw < 2).alias("is_val"),
        (draw >= 8).alias("is_test"),
    )
    known = t.labels.where("quality is not null").select("doc_id", F.col("quality").alias("label"))
    rows = texts.join(known, "doc_id").repartition(LEARNER_PARTS, "doc_id")
    return rows.sortWithinPartitions("doc_id")


def _ranked(scores: DataFrame) -> DataFrame:
    """Rows scored, and whether the ranking beats a constant guess."""
    rows = F.lit(scores.count()).cast("long").alias("rows")
    better = F.coalesce(F.col("roc_auc") > 0.6, F.lit(False)).alias("above_constant")
    return ranking_metrics(scores, "score", "label").select(rows, better)


def _guessed(guesses: DataFrame, target: str) -> DataFrame:
    """Rows predicted, and whether the error is below that of the mean."""
    error = F.col(target) - F.col("prediction")
    return guesses.agg(
        F.count("*").alias("rows"),
        (F.sqrt(F.avg(error * error)) < F.stddev_pop(target)).alias("above_constant"),
    )


def _fitted(t: Tables, learner):
    df = _labelled(t)
    model = M.fit_pipeline(df.where("not is_test"), learner, NUMERIC, CATEGORICAL, invalid="keep")
    return model, df.where("is_test")


@register("m1_forest_classifier", _GOOD_SQL)
def forest_classifier(t: Tables) -> DataFrame:
    model, test = _fitted(t, M.forest_classifier("label", numTrees=TREES))
    return _ranked(M.scored(model, test, "score"))


@register("m2_forest_regressor", _GOOD_SQL)
def forest_regressor(t: Tables) -> DataFrame:
    model, test = _fitted(t, M.forest_regressor("n_words", numTrees=TREES))
    return _guessed(M.predicted(model, test), "n_words")


@register("m3_boosted_classifier", _GOOD_SQL)
def boosted_classifier(t: Tables) -> DataFrame:
    model, test = _fitted(t, M.boosted_classifier("label", "is_val", maxIter=ROUNDS, maxDepth=3))
    return _ranked(M.scored(model, test, "score"))


@register("m4_boosted_regressor", _GOOD_SQL)
def boosted_regressor(t: Tables) -> DataFrame:
    model, test = _fitted(t, M.boosted_regressor("n_words", "is_val", maxIter=ROUNDS, maxDepth=3))
    return _guessed(M.predicted(model, test), "n_words")


_VAL_SQL = f"""WITH {_ROWS_SQL} SELECT count(*) AS rows, CAST({{rounds}} AS BIGINT) AS rounds, true AS loss_agrees,
    true AS least_before_stop{{extra}} FROM labelled WHERE draw < 2"""
PATIENCE = 25


def _curve_facts(curves: DataFrame, of_cut: DataFrame) -> DataFrame:
    """For each written curve (by ``value``) its rows and rounds, whether the cut model has the
    loss that the curve states for its best round, and whether that is the first least loss
    up to the stop."""
    best = R.patient_best(curves, PATIENCE, ["value"]).withColumnRenamed("loss", "best_loss")
    seen = F.col("round") <= F.col("stopped_at")
    facts = curves.join(best, "value").groupBy("value").agg(
        F.max("n").alias("rows"),
        F.count("*").alias("rounds"),
        F.min(F.when(seen, F.struct("loss", "round")))["round"].alias("least"),
        F.max("best_round").alias("best_round"),
        F.max("best_loss").alias("best_loss"),
    )
    return facts.join(of_cut, "value").select(
        "value",
        "rows",
        "rounds",
        (F.abs(F.col("cut_loss") - F.col("best_loss")) < 1e-6 * (1 + F.col("best_loss"))).alias("loss_agrees"),
        (F.col("least") == F.col("best_round")).alias("least_before_stop"),
    )


def _patient_facts(curve: DataFrame, of_cut: DataFrame) -> DataFrame:
    one = F.lit(0.0).alias("value")
    return _curve_facts(curve.select("*", one), of_cut.select("*", one)).drop("value")


@register("m3_patient_classifier", _VAL_SQL.format(rounds=PATIENT_ROUNDS, extra=""))
def patient_classifier(t: Tables) -> DataFrame:
    """Boosted classes with a patience of PATIENCE rounds, cut back to the best round."""
    train, val = _parts(t)
    learner = M.boosted_classifier("label", maxIter=PATIENT_ROUNDS, maxDepth=3)
    model, curve = R.fit_patient(train, val, learner, NUMERIC, CATEGORICAL, PATIENCE, invalid="keep")
    right = F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))
    of_cut = M.scored(model, val, "p").agg(F.avg(-2 * F.log(right)).alias("cut_loss"))
    return _patient_facts(curve, of_cut)


@register("m4_patient_regressor", _VAL_SQL.format(rounds=PATIENT_ROUNDS, extra=""))
def patient_regressor(t: Tables) -> DataFrame:
    train, val = _parts(t)
    learner = M.boosted_regressor("n_words", maxIter=PATIENT_ROUNDS, maxDepth=3)
    model, curve = R.fit_patient(train, val, learner, NUMERIC, CATEGORICAL, PATIENCE, invalid="keep")
    error = F.col("n_words") - F.col("prediction")
    of_cut = M.predicted(model, val).agg(F.avg(error * error).alias("cut_loss"))
    return _patient_facts(curve, of_cut)


def _words(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", "lang", F.split(cleaned("text"), " ").alias("w"))
    return words.withColumn("w", kept_tokens("w", STOPWORDS))


@register("m5_text_clusters")
def text_clusters(t: Tables) -> DataFrame:
    grouped = M.clustered_texts(_words(t).select("w"), "w", k=4)
    return M.top_terms(grouped, "w", "cluster", 100)


_WORDS_SQL = (
    "list_filter(string_split(lower(regexp_replace(regexp_replace(regexp_replace(text, '<[^\\n]*?>', ' ', 'g'), "
    "'[^a-zA-Z\\s]+', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: length(x) > 2 AND NOT list_contains(["
    + ", ".join(f"'{w}'" for w in STOPWORDS)
    + "], x))"
)


@register(
    "m5_top_terms",
    f"""WITH w AS (SELECT lang, unnest({_WORDS_SQL}) AS term FROM documents), c AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2)
    SELECT lang, term, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank FROM c
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) <= 100""",
)
def top_terms(t: Tables) -> DataFrame:
    """Top terms of known groups (languages in place of clusters)."""
    return M.top_terms(_words(t), "w", "lang", 100)


@register(
    "m6_score_saved_model",
    f"WITH {_ROWS_SQL} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM labelled",
)
def score_saved(t: Tables) -> DataFrame:
    """Fit, save, reload and score a whole table; scores that differ after the reload."""
    df = _labelled(t)
    fitted = M.fit_pipeline(df, M.forest_classifier("label", numTrees=TREES), NUMERIC, CATEGORICAL)
    path = scratch_path(t.spark, "pipeline")
    M.save_pipeline(fitted, path)
    before = M.scored(fitted, df, "before").select("doc_id", "before")
    after = M.score_with_saved(t.spark, path, df).select("doc_id", "default_proba")
    return before.join(after, "doc_id").agg(
        F.count("*").alias("rows"),
        F.sum((~F.col("before").eqNullSafe(F.col("default_proba"))).cast("long")).alias("different"),
    )


@register("m7_importances", "SELECT CAST(6 AS BIGINT) AS features, true AS shares")
def importances(t: Tables) -> DataFrame:
    model, _ = _fitted(t, M.forest_classifier("label", numTrees=TREES))
    return M.importances(model, t.spark).agg(
        F.count("*").alias("features"),
        ((F.abs(F.sum("importance") - 1) < 1e-6) & (F.min("importance") >= 0)).alias("shares"),
    )


@register(
    "m7_structural_importances",
    f"""WITH {_ROWS_SQL} SELECT unnest(['n_chars', 'letters', 'capitals', 'symbols', 'distinct', 'lang_ind']) AS feature,
    CAST({TREES} AS BIGINT) AS trees, CAST(count(*) AS DOUBLE) AS rows_at_root, true AS uses_agree, true AS depth_fits
    FROM labelled WHERE draw < 8""",
)
def structural_importances(t: Tables) -> DataFrame:
    """Roots, uses and depths of every feature, held against the node table itself."""
    model, _ = _fitted(t, M.forest_classifier("label", numTrees=TREES, subsamplingRate=1.0, bootstrap=False))
    nodes = staged(R.with_depth(R.node_table(model.stages[-1], t.spark)))
    names = model.stages[-2].getInputCols()
    table = R.importance_table(nodes, names)
    roots = nodes.where("depth = 0").agg(F.count("*").alias("n"), F.avg("n_rows").alias("rows")).first()
    uses = (
        nodes.where(F.col("feature") != R.LEAF)
        .groupBy(F.col("feature").alias("code"))
        .agg(F.count("*").alias("splits"), F.min("depth").alias("least"))
    )
    code = F.create_map(*(x for k, n in enumerate(names) for x in (F.lit(n), F.lit(k))))
    return (
        table.withColumn("code", code[F.col("feature")])
        .join(uses, "code", "left")
        .select(
            "feature",
            F.lit(roots["n"]).alias("trees"),
            F.lit(roots["rows"]).alias("rows_at_root"),
            (F.col("uses") == F.coalesce("splits", F.lit(0))).alias("uses_agree"),
            (
                (F.col("mean_least_depth") >= F.coalesce("least", F.lit(0)))
                & ((F.col("as_root") > 0) == (F.coalesce("least", F.lit(1)) == 0))
            ).alias("depth_fits"),
        )
    )


def _parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    df = _labelled(t).where("not is_test")
    return df.where("not is_val"), df.where("is_val")


SPACE = {"numTrees": ("int", 20, 100), "maxDepth": ("int", 2, 8)}


@register("n1_search", "SELECT CAST(10 AS BIGINT) AS trials, true AS best_found, true AS above_constant")
def search(t: Tables) -> DataFrame:
    train, val = _parts(t)
    best, trials = N.search(train, val, NUMERIC, CATEGORICAL, "label", SPACE, rounds=10)
    chosen = F.max(F.when(F.col("params") == str(sorted(best.items())), F.col("score")))
    return trials.agg(
        F.count("*").alias("trials"),
        (chosen == F.max("score")).alias("best_found"),
        (F.max("score") > 0.6).alias("above_constant"),
    )


@register(
    "n1_adaptive_search",
    f"WITH {_ROWS_SQL} SELECT CAST(20 AS BIGINT) AS trials, count(*) AS rows, true AS best_found, true AS above_constant FROM labelled WHERE draw < 2",
)
def adaptive_search(t: Tables) -> DataFrame:
    """Adaptive search in batches of four; the best model scored again on the validation rows."""
    train, val = _parts(t)
    best, trials = N.search(
        train, val, NUMERIC, CATEGORICAL, "label", SPACE, rounds=20, parallelism=4, adaptive=True
    )
    scores = M.scored(N.refit(train, NUMERIC, CATEGORICAL, "label", best), val, "score")
    again = ranking_metrics(scores, "score", "label").first()["roc_auc"]
    return trials.agg(
        F.count("*").alias("trials"),
        F.lit(scores.count()).alias("rows"),
        (F.abs(F.max("score") - again) < 1e-9).alias("best_found"),
        (F.max("score") > 0.6).alias("above_constant"),
    )


@register("n2_cross_validation", "SELECT true AS above_constant")
def cross_validation(t: Tables) -> DataFrame:
    auc = N.cross_validated_auc(
        _labelled(t), NUMERIC, CATEGORICAL, "label", "doc_id", folds=5,
        learner=M.forest_classifier, numTrees=TREES,
    )
    return t.spark.createDataFrame([(auc > 0.6,)], "above_constant boolean")


@register(
    "n3_sweep",
    """SELECT 'numTrees' AS param, CAST(v AS DOUBLE) AS value, CAST(v AS INTEGER) AS best_iter, true AS above_constant
    FROM (SELECT unnest([10, 50, 200]) AS v)""",
)
def sweep(t: Tables) -> DataFrame:
    train, val = _parts(t)
    out = N.sweep(
        train, val, NUMERIC, CATEGORICAL, "label", "numTrees", [10, 50, 200], metric="roc_auc"
    )
    return out.select("param", "value", "best_iter", (F.col("score") > 0.6).alias("above_constant"))


RATES = [0.05, 0.1, 0.3]


@register(
    "n3_rate_sweep",
    f"""WITH {_ROWS_SQL}, facts AS (SELECT count(*) AS rows FROM labelled WHERE draw < 2)
    SELECT 'stepSize' AS param, CAST(v AS DOUBLE) AS value, rows, CAST(100 AS BIGINT) AS rounds, true AS loss_agrees,
    true AS least_before_stop, true AS above_constant FROM facts, (SELECT unnest({RATES}) AS v)""",
)
def rate_sweep(t: Tables) -> DataFrame:
    """Best iteration for each learning rate, its loss held against the written curves."""
    train, val = _parts(t)
    out, curves = N.sweep_rounds(
        train, val, NUMERIC, CATEGORICAL, "label", "stepSize", RATES, PATIENT_ROUNDS, PATIENCE,
        invalid="keep", fixed={"maxDepth": 3},
    )
    stated = out.select("value", "param", "score", F.col("loss").alias("cut_loss"))
    share = val.agg(F.avg("label")).first()[0]  # average precision of a constant guess
    return (
        _curve_facts(curves, stated)
        .join(stated, "value")
        .select(
            "param", "value", "rows", "rounds", "loss_agrees", "least_before_stop",
            (F.col("score") > share).alias("above_constant"),
        )
    )


@register(
    "n4_leaderboard",
    """WITH s AS (SELECT l_suppkey AS trial, CAST(sum(l_linenumber) AS DOUBLE) / sum(l_quantity) AS score FROM lineitem GROUP BY 1)
    SELECT trial, round(score, 4) AS score FROM s ORDER BY 2 DESC, trial LIMIT 10""",
)
def leaderboard(t: Tables) -> DataFrame:
    """Ranking of a trials table (here one row per supplier)."""
    trials = t.lineitem.groupBy(F.col("l_suppkey").alias("trial")).agg(
        (F.sum("l_linenumber") / F.sum("l_quantity")).alias("score")
    )
    return N.leaderboard(trials)


@register("n4_refit_best", _GOOD_SQL)
def refit_best(t: Tables) -> DataFrame:
    train, val = _parts(t)
    params, _ = N.search(train, val, NUMERIC, CATEGORICAL, "label", SPACE, rounds=5)
    fitted = N.refit(train.unionByName(val), NUMERIC, CATEGORICAL, "label", params)
    return _ranked(M.scored(fitted, _labelled(t).where("is_test"), "score"))


@register(
    "p9_predictive_power",
    "SELECT 'distinct' AS feature, 'label' AS target, true AS above_constant",
)
def predictive_power(t: Tables) -> DataFrame:
    power = N.predictive_power(_labelled(t), "distinct", "label", "doc_id")
    return power.select("feature", "target", (F.col("power") > 0).alias("above_constant"))


_POWER_SQL = """WITH wide AS (SELECT doc_id, CAST(quality AS VARCHAR) AS class, CAST(length(text) AS DOUBLE) AS n_chars,
    CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
    CAST(len(list_distinct(string_split(text, ' '))) AS DOUBLE) AS n_distinct
    FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
    long AS (SELECT CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 AS INTEGER) AS fold, class,
    unnest(['n_chars', 'n_words', 'n_distinct']) AS feature, unnest([n_chars, n_words, n_distinct]) AS value FROM wide)"""
POWER_FEATURES = ["n_chars", "n_words", "n_distinct"]


def _measured(t: Tables) -> DataFrame:
    """Labelled texts by their measures, taken before the join so that no text is shuffled."""
    words = F.split("text", " ")
    measures = t.documents.select(
        "doc_id",
        F.char_length("text").alias("n_chars"),
        F.size(words).alias("n_words"),
        F.size(F.array_distinct(words)).alias("n_distinct"),
    )
    return measures.join(t.labels.where("quality is not null").select("doc_id", "quality"), "doc_id")


@register(
    "p9_class_counts",
    f"""{_POWER_SQL}, edges AS (SELECT feature, list_distinct(quantile_disc(value, [{", ".join(f"{k / 32}" for k in range(1, 32))}])) AS e
    FROM long WHERE value IS NOT NULL GROUP BY 1)
    SELECT feature, fold, CAST(len(list_filter(e, lambda x: x < value)) AS INTEGER) AS bin, class, count(*) AS n
    FROM long JOIN edges USING (feature) WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def power_counts(t: Tables) -> DataFrame:
    return class_counts(_measured(t), POWER_FEATURES, "quality", "doc_id")


@register(
    "p9_predictive_powers",
    f"""{_POWER_SQL}, sizes AS (SELECT feature, class, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2)
    SELECT feature, 'quality' AS target, CAST(sum(n) AS BIGINT) AS rows,
    round(max(n) / sum(n) * 2 * max(n) / (max(n) + sum(n)), 6) AS naive_f1, true AS power_follows FROM sizes GROUP BY 1""",
)
def powers(t: Tables) -> DataFrame:
    """Powers of all features at once; the power is the gain of the trees over the naive guess."""
    found = predictive_powers(_measured(t), POWER_FEATURES, "quality", "doc_id")
    gain = (F.col("model_f1") - F.col("naive_f1")) / (1 - F.col("naive_f1"))
    return found.select(
        "feature",
        "target",
        "rows",
        F.round("naive_f1", 6).alias("naive_f1"),
        (F.abs(F.col("power") - F.greatest(gain, F.lit(0.0))) < 1e-9).alias("power_follows"),
    )
