"""Parquet copies that are published as a whole: a manifest names the files, and is written last."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill import storage

MANIFEST = "_manifest.json"


class DamagedCopy(ValueError):
    """What is stored is not what was written."""


def parquet_if_absent(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False
) -> DataFrame:
    """Read the Parquet copy at ``path``, building it first where there is none.

    A copy is written to a folder of its own below ``path``. The manifest, which has its files,
    their sizes and the row count, is created after that, and whoever reads looks there first:
    a build that was lost halfway is as good as none. Of several builders at once the
    first to create the manifest has built the copy; the others remove theirs and read it.

    Parquet that somebody else has written to ``path`` gets a manifest if its writer has left
    ``_SUCCESS``. Without it, and wherever the files are not those of the manifest, ``DamagedCopy`` is
    raised. With ``rebuild`` a new copy is then built and takes the damaged one's place,
    whose files stay. ``build`` is not called when there is a sound copy.
    """
    try:
        manifest = read_manifest(spark, path) or _adopted(spark, path)
    except DamagedCopy:
        if not rebuild:
            raise
        storage.remove(spark, f"{path}/{MANIFEST}")
        manifest = None
    if manifest is None:
        _publish(spark, path, _written(spark, path, build()))
        manifest = read_manifest(spark, path)
    return spark.read.parquet(_data(path, manifest))


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the copy at ``path``, compared with the files there are; None if there is none."""
    if not storage.exists(spark, f"{path}/{MANIFEST}"):
        return None
    manifest = json.loads(storage.read_text(spark, f"{path}/{MANIFEST}"))
    wanted = dict(manifest["files"])
    found = dict(_files(spark, _data(path, manifest)))
    if wanted != found:
        odd = sorted(name for name in wanted.keys() | found.keys() if wanted.get(name) != found.get(name))
        raise DamagedCopy(f"{path}: missing, changed or added since the copy was written: {odd[:10]}")
    return manifest


def _data(path: str, manifest: dict) -> str:
    return f"{path}/{manifest['folder']}" if manifest["folder"] else path


def _files(spark: SparkSession, folder: str, below: str = "") -> list[tuple[str, int]]:
    """Data files in a folder and its subfolders, by relative name, with their sizes."""
    found = []
    for entry in storage.entries(spark, f"{folder}/{below}" if below else folder):
        if entry.name[0] in "_.":
            continue
        name = f"{below}/{entry.name}" if below else entry.name
        found += _files(spark, folder, name) if entry.is_folder else [(name, entry.size)]
    return found


def _written(spark: SparkSession, path: str, copied: DataFrame) -> dict:
    folder, counted = f"copy-{uuid.uuid4().hex}", Observation()
    copied.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}")
    return {"folder": folder, "rows": counted.get["rows"], "files": _files(spark, f"{path}/{folder}")}


def _adopted(spark: SparkSession, path: str) -> dict | None:
    """A manifest for what another writer has left, if there is any data but unpublished copies."""
    files = [(name, size) for name, size in _files(spark, path) if not name.startswith("copy-")]
    if not files:
        return None
    if not storage.exists(spark, f"{path}/_SUCCESS"):
        raise DamagedCopy(f"{path} holds data, but its writer has not finished: there is no _SUCCESS")
    _publish(spark, path, {"folder": "", "rows": spark.read.parquet(path).count(), "files": files})
    return read_manifest(spark, path)


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    if not storage.create(spark, f"{path}/{MANIFEST}", json.dumps(manifest)) and manifest["folder"]:
        storage.remove(spark, f"{path}/{manifest['folder']}")
