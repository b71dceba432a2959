"""Session helpers: checkpoint folder and session settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pagemill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings every job of this package relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Call-site capture costs more than building the large expressions themselves.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a laptop) is a scratch folder used instead.
    The reliable checkpoint survives the loss of executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="pagemill-ckpt-"))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it; a scratch folder in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.getCheckpointDir() is None:
            cut_lineage(spark.range(1))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """Give a costly per-row step one task per core when the input has fewer files than cores.

    The list of input files is known without running anything. A large table has many more files
    than cores and comes back unchanged, so nothing is shuffled at scale.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if len(df.inputFiles()) < wanted else df
