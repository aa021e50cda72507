"""Session settings and reliable staging of intermediate tables."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_STAGED: list[str] = []


def build_session(
    app: str = "fieldmill",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with adaptive execution and a UTC clock.

    Shuffle partition counts are left to the cluster: adaptive execution
    coalesces them, so a large value is the safe one for large inputs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the session.

    A machine-local folder is made only for a local master, where driver and
    executors are one process.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="fieldmill-")
    context.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, for tables written between stages."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back from there.

    Used where a later step must see exactly the rows, and exactly the
    partition numbers, that an earlier step saw, even after executors are lost.
    A columnar table lets each later step read only the columns it needs.
    """
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables staged by this process, once no frame needs them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        removed += path.getFileSystem(conf).delete(path, True)
    return removed


def kept(df: DataFrame) -> DataFrame:
    """Persist a table that several actions read, spilling to disk when needed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def few_parts(df: DataFrame, per_core: int = 3) -> DataFrame:
    """``df`` in at most ``per_core`` partitions a core, without a shuffle.

    For learners of trees: every partition fills and sends statistics of all nodes of a
    level, however few rows it has, so their size grows with the number of partitions.
    ``df`` should be held already, else one task makes several partitions side by side.
    """
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    The archive goes to the shared folder and from there through Spark's own file
    distribution, so nothing has to be installed on the machines of a cluster.
    """
    context = spark.sparkContext
    if getattr(context, "_package_shipped", None):
        return
    top, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, file.relative_to(top.parent))
    name = scratch_path(spark, "package") + ".zip"
    where = spark._jvm.org.apache.hadoop.fs.Path(name)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(name)
    context._package_shipped = name
