"""Session helper and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings the operators are laid out for. Shuffle partitions are for the cluster to set:
# about 128 MB of shuffle data each, which AQE then coalesces where a stage has less.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join of a hot key is split even where that costs the aggregate above it a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Clean-up stages are long lists of expressions. Methods above this size are not
    # compiled by the JVM, so such stages run faster operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

WORK_DIR_SETTING = "spark.checkpoint.dir"
_session_roots: dict[str, str] = {}
_stored: dict[str, list[str]] = {}


def local_session(app: str = "terrace", cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config(map=SETTINGS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates and stream state.

    The cluster names it in ``spark.checkpoint.dir``. A local session without the
    setting gets a temporary folder; a cluster without it is an error, because a
    machine-local folder is not visible to other executors.
    """
    shared = spark.conf.get(WORK_DIR_SETTING, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {WORK_DIR_SETTING} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _session_roots:
        _session_roots[app] = tempfile.mkdtemp(prefix="terrace-")
    return _session_roots[app]


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the work root, which ``release`` deletes."""
    path = f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"
    _stored.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def release(spark: SparkSession) -> None:
    """Delete all that this application stored in its work folder, once its results are written."""
    for path in _stored.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def release_path(df: DataFrame) -> None:
    """Delete one frame that ``materialize`` returned, once nothing reads it any more."""
    spark = df.sparkSession
    mine = _stored.get(spark.sparkContext.applicationId, [])
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        name = path.rsplit("/", 1)[-1]
        for known in [p for p in mine if p.rsplit("/", 1)[-1] == name]:
            mine.remove(known)
            _delete(spark, known)


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``, which stays as it is if that fails."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{new}-old"
    fs.mkdirs(hadoop(path).getParent())
    had = fs.exists(hadoop(path))
    if had and not fs.rename(hadoop(path), hadoop(old)):
        raise OSError(f"cannot move {path} away")
    moved = False
    try:
        moved = fs.rename(hadoop(new), hadoop(path))
    finally:
        # Some file systems say that a move failed, others raise.
        if had and not moved:
            fs.rename(hadoop(old), hadoop(path))
    if not moved:
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(hadoop(old), True)


def materialize(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the work folder and read it back, with the columns of ``schema`` if given.

    Cuts the lineage so that a lost executor costs a re-read, and gives Catalyst the
    true file size, so that it broadcasts the result only when it is small.
    """
    spark = df.sparkSession
    path = new_work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)
