"""Versions of the scoring bundle: written in parts, in force in one step.

A version is a folder of its own. Its manifest lists every file with length and
SHA-256 and is written last, under a hidden name, and then renamed to the next
number; the highest number is the version in force. A folder without a manifest
is no version, and one whose files differ from its manifest is passed over, so a
half-written or damaged version is never loaded. Manifests are never overwritten:
of two writers that want the same number, one takes the next.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from keepwell.operators.score import Bundle
from keepwell.sources import tables

_DIGITS = 8


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    files: dict[str, tuple[int, str]]


def file_sums(spark: SparkSession, folder: str) -> dict[str, tuple[int, str]]:
    """Length and digest of every file below ``folder``, by its relative path. The
    files of a bundle are few and hold models, not accounts."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
        "path", "length", F.sha2("content", 256).alias("digest")).collect()
    top = folder.rstrip("/").split("/")[-1]
    return {r["path"].rsplit(f"/{top}/", 1)[1]: (r["length"], r["digest"]) for r in rows}


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Manifest numbers, newest first."""
    names = tables.list_names(spark, f"{root}/manifests")
    return sorted((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), reverse=True)


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/manifests/{number:0{_DIGITS}d}.json"


def publish(bundle: Bundle, root: str) -> Version:
    """Stores ``bundle`` and puts it in force."""
    spark = SparkSession.active()
    folder = f"bundle-{uuid.uuid4().hex}"
    bundle.save(f"{root}/versions/{folder}")
    files = file_sums(spark, f"{root}/versions/{folder}")
    hidden = f"{root}/manifests/.{folder}"
    tables.write_text(spark, hidden, json.dumps({"folder": folder, "files": files}))
    number = max(_numbers(spark, root), default=0) + 1
    while not tables.rename_new(spark, hidden, _manifest_path(root, number)):
        number += 1
    return Version(number, folder, files)


def newest(spark: SparkSession, root: str) -> Version | None:
    """The version in force: the newest whose files are all as its manifest says."""
    for number in _numbers(spark, root):
        note = json.loads(tables.read_text(spark, _manifest_path(root, number)))
        files = {path: (size, digest) for path, (size, digest) in note["files"].items()}
        folder = f"{root}/versions/{note['folder']}"
        if tables.path_exists(spark, folder) and file_sums(spark, folder) == files:
            return Version(number, note["folder"], files)
    return None


class CurrentBundle:
    """The bundle in force, loaded when asked and again when another one is. The
    newest manifest number is one listing; files are only summed for a new one."""

    def __init__(self, root: str):
        self.root = root
        self._listed: int | None = None
        self._held: tuple[Version, Bundle] | None = None

    def get(self) -> tuple[int, Bundle]:
        spark = SparkSession.active()
        listed = max(_numbers(spark, self.root), default=0)
        if self._held is None or listed != self._listed:
            version = newest(spark, self.root)
            if version is None:
                raise FileNotFoundError(f"no whole bundle below {self.root}")
            if self._held is None or version.number != self._held[0].number:
                self._held = version, Bundle.load(f"{self.root}/versions/{version.folder}")
            self._listed = listed
        return self._held[0].number, self._held[1]
