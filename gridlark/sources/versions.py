"""A pointer kept as a log of numbered versions, each created once or not at all.

Whoever wants to move the pointer says which version it saw; the next number is created
only if nobody else has created it, so of two writers one is refused. Nothing is
overwritten. The files are a few bytes each and are written and listed by the driver, with
the file system of the folder.
"""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 12


class Outdated(RuntimeError):
    """The pointer has moved since it was read."""


@dataclass(frozen=True)
class Version:
    number: int
    entry: dict


def _filesystem(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _filesystem(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().endswith(".json"))


def _read(spark: SparkSession, folder: str, name: str) -> dict | None:
    fs, path = _filesystem(spark, f"{folder}/{name}")
    stream = fs.open(path)
    try:
        text = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    return json.loads(text) if text else None


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """All versions, oldest first; empty without a log. One being written has no entry yet and is left out."""
    found = ((int(n.removesuffix(".json")), _read(spark, folder, n)) for n in _names(spark, folder))
    return [Version(number, entry) for number, entry in found if entry is not None]


def latest(spark: SparkSession, folder: str) -> Version | None:
    """The newest version, or None."""
    for name in reversed(_names(spark, folder)):
        entry = _read(spark, folder, name)
        if entry is not None:
            return Version(int(name.removesuffix(".json")), entry)
    return None


def append(spark: SparkSession, folder: str, entry: dict, seen: int) -> Version:
    """Create version ``seen + 1``; :class:`Outdated` if there is one already or ``seen`` isn't the newest.

    ``seen`` is 0 for an empty log.
    """
    names = _names(spark, folder)
    newest = int(names[-1].removesuffix(".json")) if names else 0
    if newest != seen or not _create(spark, f"{folder}/{seen + 1:0{DIGITS}d}.json", json.dumps(entry).encode()):
        raise Outdated(f"version {seen} was read, but there is a later one")
    return Version(seen + 1, entry)


def _create(spark: SparkSession, file: str, data: bytes) -> bool:
    """Write a new file; False if it exists. Never both for two writers."""
    fs, path = _filesystem(spark, file)
    if fs.getUri().getScheme() == "file":
        # A link is made whole or refused, which local creation through the connector isn't.
        target = path.toUri().getPath()
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=os.path.dirname(target), suffix=".part", delete_on_close=False) as made:
            made.write(data)
            made.close()
            try:
                os.link(made.name, target)
            except FileExistsError:
                return False
        return True
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or fs.exists(path):
            return False
        raise
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    return True


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder and what is in it; False if it isn't there."""
    fs, path = _filesystem(spark, folder)
    return bool(fs.exists(path) and fs.delete(path, True))


def folders(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the folders in ``folder`` that begin with ``prefix``, without it."""
    fs, path = _filesystem(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName().removeprefix(prefix) for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(prefix))
