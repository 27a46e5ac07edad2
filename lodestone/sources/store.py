"""Small files beside tables, through the Hadoop file system: any storage that Spark writes to will do."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _at(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str:
    jvm, p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the target and renames, so that readers see the old text or the new one whole."""
    jvm, p, fs = _at(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(tmp, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(tmp.makeQualified(fs.getUri(), fs.getWorkingDirectory()), p.makeQualified(fs.getUri(), fs.getWorkingDirectory()), options)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no folder."""
    _, p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    _, p, fs = _at(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> Any:
    return json.loads(read_text(spark, path))


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value))
