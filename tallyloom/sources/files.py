"""Small files and folders on whatever file system a path names, through Hadoop's interface.

Manifests, watermarks and caches are seen alike by every process that sees the data, on a shared file system too.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyloom.session import local_session


def _at(path: str) -> tuple[object, object]:
    spark = SparkSession.getActiveSession() or local_session()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(path: str) -> bool:
    fs, p = _at(path)
    return fs.exists(p)


def folders(path: str) -> list[str]:
    """Names of the folders below a path, sorted; none where it does not exist."""
    fs, p = _at(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def names(path: str) -> list[str]:
    """Names of everything in a folder, sorted; none where it does not exist."""
    fs, p = _at(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def modified(path: str) -> float | None:
    """Seconds since 1970 of the last change, None where there is nothing."""
    fs, p = _at(path)
    return fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else None


def read_text(path: str) -> str:
    fs, p = _at(path)
    spark = SparkSession.getActiveSession() or local_session()
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(path: str, text: str) -> None:
    """The whole text or nothing: written beside the target and renamed, so no reader meets half of it."""
    fs, p = _at(path)
    part = p.suffix(".part")
    stream = fs.create(part, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"{path} could not be written")


def remove(path: str) -> None:
    fs, p = _at(path)
    fs.delete(p, True)


def move(path: str, target: str) -> None:
    fs, p = _at(path)
    if not fs.rename(p, _at(target)[1]):
        raise OSError(f"{path} could not be moved to {target}")
