"""Versions of several tables, published at once and safe against rival writers.

A version is one small file that names the data folders of each table. It is created only if
no file of that version exists, which the file system decides in one step; so of two writers of
one version one fails and has published nothing. A table may be made of several folders: a version that
adds a day names the folders of the version before and a new one, and rewrites none. Data that no kept
version names is dropped by ``expire``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "_versions"


class VersionTaken(RuntimeError):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Change:
    """What a version does to a table: add rows to those of the version before, or replace them."""

    rows: DataFrame
    append: bool = False


@dataclass(frozen=True)
class Version:
    """A complete version: its number, and the folders and columns of its tables."""

    number: int
    folders: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)


def _at(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def numbers(spark: SparkSession, root: str) -> list[int]:
    """All version numbers that were taken, complete or not."""
    files, folder = _at(spark, f"{root}/{_FOLDER}")
    if not files.exists(folder):
        return []
    names = (s.getPath().getName() for s in files.listStatus(folder))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def load(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version, by default the newest complete one; number 0 without tables if there is none.

    A version whose writer was stopped in the middle of its file does not count.
    """
    taken = numbers(spark, root)
    for n in [number] if number is not None else reversed(taken):
        lines = spark.read.text(f"{root}/{_FOLDER}/{n:012d}.json", wholetext=True).collect() if n in taken else []
        try:
            found = json.loads(lines[0]["value"]) if lines else None
        except ValueError:
            found = None
        if found:
            return Version(n, found["folders"], found["schemas"])
        if number is not None:
            raise LookupError(f"no complete version {number}")
    return Version(0)


def commit(spark: SparkSession, root: str, changes: dict[str, Change], base: Version | None = None) -> Version:
    """Publish the version after ``base`` (by default the newest one); tables without a change stay as they are.

    The data is written first, each table's into a new folder. ``VersionTaken`` is raised if another
    writer was faster; then read the newest version and decide anew. A crash before the last
    step leaves readers with the version before.
    """
    base = base or load(spark, root)
    taken = [n for n in numbers(spark, root) if n > base.number]
    if taken and load(spark, root).number > base.number:
        raise VersionTaken(f"version {taken[0]} is published")
    number = max(taken, default=base.number) + 1
    folders, schemas = dict(base.folders), dict(base.schemas)
    for name, change in changes.items():
        schema = change.rows.schema.json()
        before = folders.get(name, []) if change.append else []
        if before and schemas[name] != schema:
            raise ValueError(f"{name}: the columns differ from those of version {base.number}")
        path = f"{name}/{uuid.uuid4().hex}"
        change.rows.write.parquet(f"{root}/{path}")
        folders[name], schemas[name] = [*before, path], schema
    files, place = _at(spark, f"{root}/{_FOLDER}/{number:012d}.json")
    try:
        out = files.create(place, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error) or files.exists(place):
            raise VersionTaken(f"version {number} is published") from error
        raise
    try:
        out.write(bytearray(json.dumps({"folders": folders, "schemas": schemas}).encode()))
    finally:
        out.close()
    return Version(number, folders, schemas)


def tables(spark: SparkSession, root: str, version: Version) -> dict[str, DataFrame]:
    """The tables of a version."""
    from pyspark.sql.types import StructType

    return {
        name: spark.read.schema(StructType.fromJson(json.loads(version.schemas[name]))).parquet(*[f"{root}/{p}" for p in paths])
        for name, paths in version.folders.items()
    }


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` complete versions, and the folders that only they name; those folders.

    Folders that no version names are left alone: a writer may be about to publish them.
    """
    known = []
    for number in reversed(numbers(spark, root)):
        try:
            known.append(load(spark, root, number))
        except LookupError:
            continue
    kept = {p for v in known[:keep] for own in v.folders.values() for p in own}
    gone = sorted({p for v in known[keep:] for own in v.folders.values() for p in own} - kept)
    for version in known[keep:]:
        files, place = _at(spark, f"{root}/{_FOLDER}/{version.number:012d}.json")
        files.delete(place, False)
    for path in gone:
        files, place = _at(spark, f"{root}/{path}")
        files.delete(place, True)
    return gone
