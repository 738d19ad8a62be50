"""Versions of a table: numbered manifests, each a small text that names the folders which make up the table.

Data is written into folders of its own first and its manifest last, under the next number, which only one writer can
take. Readers follow the newest complete manifest, so a job that dies anywhere leaves the table as it was. Absence is
told by listing: whatever else goes wrong while a table is read is raised.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Last line of a manifest; one without it was cut off while it was written and does not count.
_END = "end"


class Conflict(Exception):
    """Another writer has taken the number."""


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def entries(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    where, files = _at(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    where, files = _at(spark, path)
    files.delete(where, True)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    return sorted((int(n) for n in entries(spark, f"{table}/manifests") if n.isdigit()), reverse=True)


def _lines(spark: SparkSession, table: str, version: int) -> list[str] | None:
    where, files = _at(spark, f"{table}/manifests/{version}")
    stream = files.open(where)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    finally:
        stream.close()
    return lines[:-1] if lines[-1] == _END else None


def current(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number and lines of the newest complete manifest; None if the table has none."""
    for version in _numbers(spark, table):
        if (lines := _lines(spark, table, version)) is not None:
            return version, lines
    return None


def following(spark: SparkSession, table: str) -> int:
    """The next number that is free."""
    return max(_numbers(spark, table), default=-1) + 1


def publish(spark: SparkSession, table: str, version: int, lines: list[str]) -> None:
    """Write manifest ``version``; from then on readers see it. Raises ``Conflict`` if that number is taken."""
    where, files = _at(spark, f"{table}/manifests/{version}")
    try:
        stream = files.create(where, False)
    except Exception as e:
        if files.exists(where):
            raise Conflict(version) from e
        raise
    try:
        stream.write(bytearray("\n".join([*lines, _END]).encode()))
    finally:
        stream.close()


def forget(spark: SparkSession, table: str, named, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` manifests, and the data folders that only the others name.

    ``named(lines)`` gives a manifest's folders below ``data``. Folders that no manifest names may belong to a writer at
    work and stay.
    """
    told = {v: named(lines) for v in _numbers(spark, table) if (lines := _lines(spark, table, v)) is not None}
    kept = sorted(told, reverse=True)[:keep]
    if not kept:
        return
    in_use = set().union(*(told[v] for v in kept))
    for v, folders in told.items():
        if v not in kept:
            remove(spark, f"{table}/manifests/{v}")
            for folder in set(folders) - in_use:
                remove(spark, f"{table}/data/{folder}")
