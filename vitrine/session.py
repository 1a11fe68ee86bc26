"""Session defaults: UTC, ANSI and AQE on; sizes are left to the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "vitrine", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application (they need not have it installed)."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_vitrine_shipped", False):
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="vitrine-")) / "vitrine.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    context.addPyFile(str(archive))
    context._vitrine_shipped = True


def scratch_root(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which driver and executors share; below a temporary folder only where that is unset and the
    session is local."""
    import tempfile
    import uuid

    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="vitrine-")
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"
