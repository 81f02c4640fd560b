"""Sessions, and the shared folder that written tables and checkpoints go to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "saleswright", cores: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A session that names none has a folder under its warehouse, which is shared as well.
    A folder of one machine would be lost with it, so a cluster may not name one by accident:
    a warehouse on a local path is refused unless the master is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or ""
        local = context.master == "local" or context.master.startswith("local[")
        if not local and (warehouse.startswith("file:") or "://" not in warehouse):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{warehouse.rstrip('/')}/_scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else writes to.

    All paths of an application lie in one folder, which can go when the application is over.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{application}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written by ``scratch_path``, once results are consumed.

    The application calls it, at its end: a query's result is still to be read from there when the
    query returns, so no query can.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(conf).delete(path, True)
