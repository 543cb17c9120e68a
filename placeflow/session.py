"""Session helpers: sensible defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every placeflow job wants; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole documents pass through the Arrow functions: keep batches modest
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    # codes such as ind_code=0009 must stay strings when read back from paths
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "placeflow") -> SparkSession:
    """A local session for tests, the bench and the smoke entry."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PLACEFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.driver.extraJavaOptions", "-Dlog4j.rootLogger=ERROR")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a scratch folder set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="placeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/placeflow-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage at a stage boundary: a written table under the shared
    ``spark.checkpoint.dir`` (survives lost executors; never localCheckpoint). Read back as
    Parquet, later steps still prune columns, push filters down and know its size."""
    path = scratch_dir(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``placeflow`` importable in the Python workers (Arrow functions,
    ``mapInPandas``) wherever the driver was started: zip the package once and
    hand it to ``SparkContext.addPyFile``, once per context."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="placeflow-pkg-"), "placeflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
