"""Results kept on disk by their plan and the state of their inputs, for a time."""

from __future__ import annotations

import hashlib
import re
import time

from pyspark.sql import DataFrame

from tallyloom.sources import files


def digest(df: DataFrame) -> str:
    """256 bits of the plan as written and of the names and times of the files it reads.

    Equal plans over unchanged files have equal digests; a file that is written anew changes it. Numbers that only name
    expressions within one session do not count.
    """
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString())
    schema = df.schema.json()
    inputs = sorted(f"{f} {files.modified(f)}" for f in df.inputFiles())
    return hashlib.sha256("\0".join([plan, schema, *inputs]).encode()).hexdigest()


def cached(df: DataFrame, root: str, ttl_s: float = 86_400.0) -> DataFrame:
    """The result of an equal plan over equal files written less than ``ttl_s`` ago, else the result after writing it."""
    spark, path = df.sparkSession, f"{root}/plan-{digest(df)}"
    at = files.modified(f"{path}/_SUCCESS")
    if at is None or time.time() - at >= ttl_s:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
