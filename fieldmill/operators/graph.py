"""Features of many graphs given as one edge table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEGREES = (
    "global_source_degrees",
    "global_dest_degrees",
    "local_source_degrees",
    "local_dest_degrees",
)


def node_statistics(df: DataFrame, features: Sequence[str], by: str = "_id") -> DataFrame:
    """Mean, minimum, maximum and sample deviation of each feature per graph."""
    kinds = {"avg": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp}
    return df.groupBy(by).agg(
        *(fn(f).alias(f"{kind}_{f}") for f in features for kind, fn in kinds.items())
    )


def graph_sizes(edges: DataFrame, by: str = "_id", source: str = "from", target: str = "to") -> DataFrame:
    """Edges and distinct nodes (over both ends) of each graph.

    Each edge yields its two ends, counted first per (graph, node) and then per
    graph, so the nodes of a large graph never meet in one task. Every edge has
    two end rows, hence half their number is the edge count.
    """
    ends = edges.select(
        by, F.explode(F.array(F.col(source), F.col(target))).alias("__node")
    )
    per_node = ends.groupBy(by, "__node").agg(F.count("*").alias("__ends"))
    return per_node.groupBy(by).agg(
        (F.sum("__ends") / 2).cast("long").alias("n_connections"),
        F.count("*").alias("n_unique_nodes"),
    )


def graph_features(
    edges: DataFrame, node_features: Sequence[str] = DEGREES, by: str = "_id",
    source: str = "from", target: str = "to", featured: DataFrame | None = None,
) -> DataFrame:
    """Graph sizes, joined with node statistics when there are node features.

    The two parts read the edges separately: sizes need a narrow shuffle by
    (graph, node), statistics only partial sums per graph. ``featured`` names
    the frame with the features if they were derived from ``edges``, so that
    the sizes do not derive them again.
    """
    sizes = graph_sizes(edges, by, source, target)
    if not node_features:
        return sizes
    source_rows = featured if featured is not None else edges
    return sizes.join(node_statistics(source_rows, node_features, by), by)


def degrees(edges: DataFrame, by: str = "_id", source: str = "from", target: str = "to") -> DataFrame:
    """Edges with out- and in-degrees of their ends, overall and within the graph."""
    # struct keys, so that edges with a null end or graph stay and are counted
    def sized(keys: list[str], key: str, name: str) -> DataFrame:
        return edges.groupBy(F.struct(*keys).alias(key)).agg(F.count("*").alias(name))

    out = edges
    for n, (keys, name) in enumerate(
        (
            ([source], "global_source_degrees"),
            ([target], "global_dest_degrees"),
            ([by, source], "local_source_degrees"),
            ([by, target], "local_dest_degrees"),
        )
    ):
        out = out.withColumn(f"__key{n}", F.struct(*keys))
        out = out.join(sized(keys, f"__key{n}", name), f"__key{n}").drop(f"__key{n}")
    return out


def _weighted_statistics(value: Column, weight: Column, name: str) -> list[Column]:
    """Mean, minimum, maximum and sample deviation of ``value``, each row counted ``weight`` times.

    The deviation comes from exact decimal sums; sums beyond 38 digits are taken in floats.
    """
    n = F.sum(weight)
    exact = value.cast("decimal(19,0)")
    first, second = F.try_sum(exact * weight), F.try_sum(exact * exact * weight)
    spread = F.try_subtract(F.try_multiply(n, second), F.try_multiply(first, first)).cast("double")
    loose = F.sum(value.cast("double") * value * weight) - F.pow(F.sum(value.cast("double") * weight), 2) / n
    variance = F.coalesce(spread / n, F.greatest(loose, F.lit(0.0))) / (n - 1)
    return [
        (F.sum(value.cast("double") * weight) / n).alias(f"avg_{name}"),
        F.min(F.when(weight > 0, value)).alias(f"min_{name}"),
        F.max(F.when(weight > 0, value)).alias(f"max_{name}"),
        F.when(n > 1, F.sqrt(variance)).alias(f"std_{name}"),
    ]


def degree_features(edges: DataFrame, by: str = "_id", source: str = "from", target: str = "to") -> DataFrame:
    """What ``graph_features`` gives for the four degrees, from one count per (graph, node).

    Edges are dealt to as many tasks as the session shuffles into, by graph and the part of
    the table they come from, and added up there per (graph, node); the counts are dealt
    again by (graph, node). So the cells that a task holds become fewer with more tasks,
    and neither a huge graph nor an edge that repeats is gathered. Degrees over all graphs
    are rolled up from these counts and joined to them; an edge's degrees are those of its
    ends, so its statistics are statistics of the ends, weighted by their edges. These move
    once more, as narrow rows, so that wide sums are only shuffled once a graph and slice.
    A null end is a node of its own; edges without a graph count for the degrees over all
    graphs but give no row.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edges.select(
        F.col(by).alias("__graph"), F.col(source).alias("__from"), F.col(target).alias("__to"),
        F.spark_partition_id().alias("__part"),
    ).repartition(tasks, "__graph", "__part")
    end = F.explode(
        F.array(
            F.struct(F.struct(F.col("__from").alias("id")).alias("node"), F.lit(1).alias("outs"), F.lit(0).alias("ins")),
            F.struct(F.struct(F.col("__to").alias("id")).alias("node"), F.lit(0).alias("outs"), F.lit(1).alias("ins")),
        )
    )
    counts = (F.sum("outs").alias("outs"), F.sum("ins").alias("ins"))
    ends = dealt.select("__graph", "__part", end.alias("end")).select("__graph", "__part", "end.*")
    partly = ends.groupBy("__graph", "__part", "node").agg(*counts)
    local = partly.repartition(tasks, "__graph", "node").groupBy("__graph", "node").agg(*counts)
    overall = local.groupBy("node").agg(F.sum("outs").alias("all_outs"), F.sum("ins").alias("all_ins"))
    own = (
        local.join(overall, "node")
        .select(F.struct("__graph").alias("__slot"), "outs", "ins", "all_outs", "all_ins")
        .hint("rebalance", "__slot")
    )
    outs, ins = F.col("outs"), F.col("ins")
    parts = ((F.col("all_outs"), outs), (F.col("all_ins"), ins), (outs, outs), (ins, ins))
    return own.groupBy(F.col("__slot")["__graph"].alias(by)).agg(
        F.sum("outs").alias("n_connections"),
        F.count("*").alias("n_unique_nodes"),
        *(c for (value, weight), name in zip(parts, DEGREES) for c in _weighted_statistics(value, weight, name)),
        # an aggregate, as a condition on the key would go into one use of the counts alone
        F.max(F.col("__slot")["__graph"].isNotNull()).alias("__known"),
    ).where("__known").drop("__known")
