"""Session defaults, table access and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: dict[str, str] = {}


def local_session(cores: int | str = 8, name: str = "tallyloom") -> SparkSession:
    """A local session with the settings every operator assumes (UTC, AQE, few shuffle partitions)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


#: Rows up to which a side of a join is broadcast; its size is counted first.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows, counted here, else as it is.

    For sides that are narrow and read from a file or a checkpoint, so that counting them is cheap.
    """
    return F.broadcast(df) if df.count() <= most else df


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the session names.

    ``spark.checkpoint.dir`` is read from the session. It is set here only where nothing is configured and the
    session is a local one, so that a cluster never writes to a machine-local folder.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python stages can import it there."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tallyloom-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "tallyloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent))
    sc.addPyFile(str(archive))
    _SHIPPED["app"] = sc.applicationId
