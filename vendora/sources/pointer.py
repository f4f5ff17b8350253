"""Numbered pointers: small JSON values beside the data they name. The highest counts, and each is put in place by one rename.

A reader finds the value before or the value after, never none; a writer that stops half-way leaves what was there. One
writer at a time is expected: a number that is taken is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_pointer"


def _home(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{FOLDER}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none where there is no folder."""
    home = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = home.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(home)) if fs.exists(home) else []


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The numbers that have a value, ascending."""
    return sorted(int(n) for n in folders(spark, f"{root.rstrip('/')}/{FOLDER}") if n.isdigit())


def put(spark: SparkSession, root: str, value: dict) -> int:
    """Put the next value in place and return its number."""
    fs, home = _home(spark, root)
    fs.mkdirs(home)
    number = max(numbers(spark, root), default=-1) + 1
    draft, name = (spark._jvm.org.apache.hadoop.fs.Path(home, n) for n in (f".{uuid.uuid4().hex}", str(number)))
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(name) or not fs.rename(draft, name):
        fs.delete(draft, False)
        raise FileExistsError(f"{root}: pointer {number} is taken")
    return number


def get(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The value of a number, or of the highest there is; null where there is none."""
    have = numbers(spark, root)
    if not have:
        return None
    fs, home = _home(spark, root)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(home, str(have[-1] if number is None else number)))
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
