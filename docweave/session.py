"""Session helpers: building a session for tests / local runs, reading tables,
and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, partitions: int = 8, app: str = "docweave") -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    spark = (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DOCWEAVE_DRIVER_MEM", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is only read; without it
    this raises, as a machine-local folder would lose what executors write.
    Only a local session gets a scratch folder, removed when Python exits.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        d = tempfile.mkdtemp(prefix="docweave-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments reject runtime core confs
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for staged tables below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written below the shared checkpoint folder and read again, and their
    path. Unlike a ``checkpoint()``, which keeps the size its plan was estimated at,
    this has the size of its files: over rounds of joins such estimates are
    multiplied, and their digits grow until the driver does nothing else."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def unstage(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``docweave`` importable in Python workers (the Arrow kernels are
    pickled by reference): zip the package once per application and add it
    with ``addPyFile``, as ``--py-files`` would. Skipped when workers can
    already import it from an installed copy."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    fd, path = tempfile.mkstemp(prefix="docweave-", suffix=".zip")
    with os.fdopen(fd, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(app)
