"""Parquet tables whose writes are published in one step.

A table folder holds ``upsert_version=<id>/[col=value/...]`` data folders and
``_manifest/<number>.json``.  A manifest maps every partition of the table to
the version folder that holds its rows; the one with the highest number is the
table.  A write adds a version folder with the partitions it replaces and then
creates the next manifest, which must not exist yet, so where the store creates
files in one step (see ``_commit``) one of two concurrent writers fails and
neither loses rows.  Manifests name folders, never rows:
what the driver handles grows with the number of partitions only.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSION = "upsert_version"
_MANIFEST, _STAGING = "_manifest", "_staging"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    p = _path(spark, path)
    fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Relative folders of the partitions below ``root`` ("" for an unpartitioned table)."""
    found = [""]
    for _ in range(depth):
        found = [f"{parent}/{name}".lstrip("/") for parent in found for name in _children(spark, f"{root}/{parent}")
                 if "=" in name]
    return found


def _manifest_text(spark: SparkSession, path: str, name: str) -> str:
    file = _path(spark, f"{path}/{_MANIFEST}/{name}")
    stream = _fs(spark, path).open(file)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def snapshot(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """The table as published now: the highest manifest number, and the newest whole manifest (None: no table yet).

    A manifest that a writer left unfinished counts as a number only.
    """
    names = [n for n in _children(spark, f"{path}/{_MANIFEST}") if n.endswith(".json") and not n.startswith((".", "_"))]
    for name in reversed(names):
        try:
            return int(names[-1].split(".")[0]), json.loads(_manifest_text(spark, path, name))
        except ValueError:
            continue
    return (int(names[-1].split(".")[0]) if names else 0), None


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    return snapshot(spark, path)


def file_exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _commit(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """Create manifest ``number``, never over another one: the file itself is made with create(overwrite = false).

    On HDFS that is one step of the name node, so of two writers one fails. Stores without such a step (some object
    stores, a local disk) leave a gap of a moment between the test and the file; there, give a table one writer.
    """
    final = _path(spark, f"{path}/{_MANIFEST}/{number:012d}.json")
    try:
        stream = _fs(spark, path).create(final, False)
    except Py4JJavaError as e:
        raise RuntimeError(f"another write of {path} was published first; run this one again") from e
    stream.write(bytearray(json.dumps(manifest, ensure_ascii=False).encode("utf-8")))
    stream.close()


def _read(spark: SparkSession, path: str, manifest: dict, partitions: list[str]) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/{VERSION}={manifest['partitions'][p]}/{p}".rstrip("/") for p in partitions]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def _writer(df: DataFrame, partition_cols: list[str]):
    # balanced by AQE: small partitions share a task, a large one is split over several
    return df.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols) if partition_cols else df.write


def exists(spark: SparkSession, path: str) -> bool:
    return _manifest(spark, path)[1] is not None


def partitions(spark: SparkSession, path: str) -> list[str]:
    """The folders of the partitions that the table has."""
    manifest = snapshot(spark, path)[1]
    return sorted(manifest["partitions"]) if manifest else []


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published."""
    manifest = _manifest(spark, path)[1]
    if manifest is None:
        raise FileNotFoundError(f"no table was published at {path}")
    if not manifest["partitions"]:
        return spark.createDataFrame([], StructType.fromJson(manifest["schema"]))
    return _read(spark, path, manifest, sorted(manifest["partitions"]))


def read_partitions(spark: SparkSession, path: str, partitions: list[str],
                    known: tuple[int, dict | None] | None = None) -> DataFrame | None:
    """The table's rows of the given partitions (of the snapshot ``known``, if given); None where it has none of them."""
    manifest = (known or snapshot(spark, path))[1]
    have = [p for p in partitions if manifest is not None and p in manifest["partitions"]]
    return _read(spark, path, manifest, have) if have else None


def stage(spark: SparkSession, path: str, df: DataFrame, partition_cols: list[str]) -> tuple[DataFrame, list[str], str]:
    """Compute df once into a staging folder of the table: (rows read back, partitions that have rows, folder)."""
    folder = f"{path}/{_STAGING}/{uuid.uuid4().hex}"
    _writer(df, partition_cols).parquet(folder)
    return (spark.read.schema(df.schema).parquet(folder).select(*df.columns),
            _partitions(spark, folder, len(partition_cols)), folder)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a staging folder."""
    _fs(spark, folder).delete(_path(spark, folder), True)


def publish(spark: SparkSession, path: str, df: DataFrame, partition_cols: list[str], replaced: list[str] | None = None,
            known: tuple[int, dict | None] | None = None, note: dict | None = None) -> int:
    """Write df as a new version of the partitions it has rows in; returns their number.

    ``replaced`` names partitions that df stands for as a whole: those without rows leave the table. ``known`` is the
    snapshot that df was computed from: when another write was published since, this one fails. ``note`` is kept in the
    manifest (the number of the last batch, say).
    """
    number, manifest = known or snapshot(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{path}/{VERSION}={version}"
    _writer(df, partition_cols).parquet(folder)
    written = _partitions(spark, folder, len(partition_cols))
    partitions = dict(manifest["partitions"]) if manifest else {}
    for gone in set(replaced or []) - set(written):
        partitions.pop(gone, None)
    partitions.update(dict.fromkeys(written, version))
    new = {"schema": json.loads(df.schema.json()), "partitions": partitions}
    _commit(spark, path, number + 1, new | ({"note": note} if note is not None else {}))
    return len(written)


def retain(spark: SparkSession, path: str, manifests: int) -> int:
    """Remove all but the newest manifests and the version folders that none of these names; returns folders removed.

    To be run by the table's owner while nothing writes or reads it. Readers of an older manifest lose their files.
    """
    if manifests < 1:
        raise ValueError("at least one manifest has to stay")
    names = [n for n in _children(spark, f"{path}/{_MANIFEST}") if n.endswith(".json")]
    kept = set()
    for name in names[-manifests:]:
        kept |= set(json.loads(_manifest_text(spark, path, name))["partitions"].values())
    gone = [n for n in _children(spark, path) if n.startswith(f"{VERSION}=") and n.split("=", 1)[1] not in kept]
    for folder in [f"{path}/{n}" for n in gone] + [f"{path}/{_MANIFEST}/{n}" for n in names[:-manifests]]:
        discard(spark, folder)
    return len(gone)
