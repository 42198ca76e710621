"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Logical operators that are carried out with an exchange.
_EXCHANGING = re.compile(r"^[\s:+|-]*(Join|Aggregate|Repartition\w*|Sort|Window|GlobalLimit|Distinct|RebalancePartitions|FlatMap\w+)\b", re.MULTILINE)

_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()

# Runtime settings every job here relies on: skewed shuffle partitions are split, small
# partitions coalesced, and a join side is broadcast only after its size was measured. Where every
# piece of the smaller side is small, rows of the wide side are not sorted for the join.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime (non-static) options on an existing session and ship this package to it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application.

    Tasks that run Python import it, whatever folder the driver was started from.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="catalogrec-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session that names none (tests on one machine) gets a temporary folder; on a
    cluster a folder of the driver's machine would be out of the executors' reach.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="catalogrec-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more, and the shuffle files of finished jobs.

    Spark removes the files of a shuffle when the driver's garbage collector finds it unused.
    """
    gc.collect()
    spark._jvm.System.gc()
    remove(spark, *paths)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Distribute an input whose rows arrive in fewer partitions than there are cores.

    Files that cannot be split (quoted CSV with line breaks, one Parquet row group) would leave
    the cluster idle behind a few tasks. A file is cut by bytes, so it may have as many partitions
    as there are cores and all rows in one of them (a row group belongs to one): the rows of each are
    counted, which reads no column. Evenly filled inputs pass through unchanged, without a shuffle.
    So does an input whose plan holds an exchange: its partitions are known only after running it.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if _EXCHANGING.search(plan):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.repartition(max(parts, cores), key) if parts < cores or _crowded(df, cores) else df


def _crowded(df: DataFrame, cores: int) -> bool:
    """True if one partition holds more than twice the rows a core should get."""
    filled = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    most, total = filled.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) * cores > 2 * (total or 0)
