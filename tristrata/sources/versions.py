"""Versions of a layer: each write is a folder of its own, and a manifest names the whole one.

A reader follows the manifest, so a write that failed half way is never read. The manifest
also holds the marks of loads that went into bronze and are not in the layer yet: a run that
fails between the two leaves its mark, and the next one begins there.
"""

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

MANIFESTS = "_manifest"
VERSION = "version"
REJECTS = "load"


@dataclass(frozen=True)
class Manifest:
    """``folder`` is the version in use; ``pending`` marks (None: all) are not in it yet.

    A layer in buckets has the version of each one instead, the loads that are in it, the
    version of the aggregates' state, and the folders that the last version replaced.
    """

    number: int = 0
    folder: str | None = None
    pending: list[str | None] = field(default_factory=list)
    rejects: list[str] = field(default_factory=list)
    size: int = 0
    buckets: dict[str, str] = field(default_factory=dict)
    loads: list[str] = field(default_factory=list)
    state: str | None = None
    retired: list[str] = field(default_factory=list)


CONTENT = ("folder", "pending", "rejects", "size", "buckets", "loads", "state", "retired")
#: Manifests that stay, so that a reader who has listed them still finds the one it wants.
KEPT = 2


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    fs, where = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str):
    """Make a file of ``text``; raises where there is one. Gives its file system and path."""
    fs, where = file_system(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return fs, where


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, where = file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(where) or [])


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder; raises where that is not possible."""
    fs, where = file_system(spark, path)
    if not fs.mkdirs(where):
        raise OSError(f"cannot create {path}")


def current(spark: SparkSession, path: str) -> Manifest:
    """The manifest in force; one without a version if there is none."""
    names = [n for n in children(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]
    if not names:
        return Manifest()
    text = spark.read.text(f"{path}/{MANIFESTS}/{names[-1]}", wholetext=True).first()[0]
    return Manifest(int(names[-1].removesuffix(".json")), **json.loads(text))


def publish(spark: SparkSession, path: str, manifest: Manifest) -> Manifest:
    """Put a manifest in force by renaming a complete file, then drop all but the last two."""
    folder, number = f"{path}/{MANIFESTS}", manifest.number + 1
    content = {k: getattr(manifest, k) for k in CONTENT}
    fs, draft = write_text(spark, f"{folder}/draft-{uuid.uuid4().hex}", json.dumps(content))
    name = f"{number:08d}.json"
    if not fs.rename(draft, file_system(spark, f"{folder}/{name}")[1]):
        raise OSError(f"another run has published {name} in {folder}")
    names = [n for n in children(spark, folder) if n.endswith(".json")]
    for old in names[:-KEPT]:
        remove(spark, f"{folder}/{old}")
    return replace(manifest, number=number)


def new_version() -> str:
    return uuid.uuid4().hex[:16]


def drop_others(spark: SparkSession, path: str, column: str, keep: list[str]) -> None:
    """Remove the folders ``column=...`` of ``path`` that are not in ``keep``."""
    wanted = {f"{column}={k}" for k in keep}
    for name in children(spark, path):
        if name.startswith(f"{column}=") and name not in wanted:
            remove(spark, f"{path}/{name}")


def version_path(spark: SparkSession, path: str) -> str:
    """The folder to read: the version in use, or ``path`` itself where there are no versions."""
    folder = current(spark, path).folder
    return path if folder is None else f"{path}/{VERSION}={folder}"
