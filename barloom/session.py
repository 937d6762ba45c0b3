"""Sessions, and the package's code on the executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def local_session(name: str = "barloom", cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, unless PYTHONPATH already leads to it."""
    roots = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    app = spark.sparkContext.applicationId
    if str(_ROOT.parent) not in roots and app not in _shipped:
        path = os.path.join(tempfile.mkdtemp(prefix="barloom-"), "barloom.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(_ROOT.rglob("*.py")):
                z.write(p, p.relative_to(_ROOT.parent))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only on one machine, where none is set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
