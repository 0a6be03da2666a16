"""Results that readers can trust during a run: versioned folders and a manifest.

A result is written whole into a folder of its own, and only then named by the next numbered
manifest, which comes into place by one rename.  Readers follow the highest manifest: they
see the version before or the version after, never a part of one, and a job that dies
while it writes leaves the published version as it was.  All on Hadoop file systems.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MANIFEST = re.compile(r"manifest-(\d{12})\.json")


class Folder:
    """A folder on whatever file system its URI names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, sub: str = "") -> list[str]:
        if not self._fs.exists(self._at(sub)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(sub))]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def claim(self, attempt: str, name: str) -> bool:
        """Rename unless the name is taken."""
        return not self._fs.exists(self._at(name)) and self._fs.rename(self._at(attempt), self._at(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _manifests(folder: Folder) -> list[int]:
    return sorted(int(m[1]) for m in map(_MANIFEST.fullmatch, folder.names()) if m)


def _manifest(number: int) -> str:
    return f"manifest-{number:012d}.json"


def published_version(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The manifest (number, version, format, schema) of the newest or the given version; None if there is none."""
    folder = Folder(spark, path)
    known = _manifests(folder)
    if not known or number is not None and number not in known:
        return None
    at = known[-1] if number is None else number
    return json.loads(folder.read(_manifest(at))) | {"number": at}


def write_version(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write ``df`` into a fresh folder below ``path`` that no reader knows of; returns its name."""
    version = uuid.uuid4().hex
    writer = df.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "false")
    writer.save(f"{path.rstrip('/')}/versions/{version}")
    return version


def swap(spark: SparkSession, path: str, version: str, schema: StructType, fmt: str = "parquet") -> int:
    """Make a written version the published one; returns the manifest's number.

    Two publishers never share a number: whose rename finds the name taken tries the next one.
    """
    folder = Folder(spark, path)
    attempt = f"_attempt-{uuid.uuid4().hex}.json"
    folder.create(attempt, json.dumps({"version": version, "format": fmt, "schema": schema.json()}))
    number = (_manifests(folder) or [0])[-1] + 1
    while not folder.claim(attempt, _manifest(number)):
        number += 1
    return number


def publish(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2) -> int:
    """Write ``df`` as the new published version of ``path``; returns its number.

    The newest ``keep`` versions stay, so that a reader who has just looked up the one before can
    finish; None keeps all.
    """
    spark = df.sparkSession
    number = swap(spark, path, write_version(df, path, fmt), df.schema, fmt)
    if keep is not None:
        expire(spark, path, keep)
    return number


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest published version of ``path`` (or the given one), with the schema of its manifest."""
    found = published_version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {path}" + (f" as version {number}" if number is not None else ""))
    schema = StructType.fromJson(json.loads(found["schema"]))
    return spark.read.format(found["format"]).schema(schema).load(f"{path.rstrip('/')}/versions/{found['version']}")


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` published versions, oldest manifest first; returns the removed folders.

    Folders that no manifest names are left alone: they may belong to a running job (``orphans``).
    """
    if keep < 1:
        raise ValueError("keep must be 1 or more")
    folder, gone = Folder(spark, path), []
    for number in _manifests(folder)[:-keep]:
        version = json.loads(folder.read(_manifest(number)))["version"]
        folder.remove(_manifest(number))
        folder.remove(f"versions/{version}")
        gone.append(version)
    return gone


def orphans(spark: SparkSession, path: str) -> list[str]:
    """Version folders that no manifest names: those of running jobs, and of jobs that died before their swap."""
    folder = Folder(spark, path)
    named = {json.loads(folder.read(_manifest(n)))["version"] for n in _manifests(folder)}
    return sorted(set(folder.names("versions")) - named)
