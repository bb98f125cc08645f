"""Stored tables `<root>/<layer>/<name>` in parquet, and SQL over frames.

A published table is a set of versions. Each publish writes new folders `_version=<n>-<id>` and last a small manifest
`_manifests/<n>.json` that names the folders of that version, so a reader sees the old version or the new one, a job
that dies leaves the old one, and a table can be replaced by a frame that reads it. A partitioned table names a folder
per part: a publish can replace some parts and keep the folders of all others. A folder without manifests, such as the
output of a streaming append, is read as it is.

Versions need one file system operation to be atomic, a rename onto a name that is free; of two publishers at once
one fails.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimflow.session import STORED
from claimflow.sources.files import delete, list_names, read_small, write_once

MANIFESTS = "_manifests"
KEPT_VERSIONS = 2  # the current one, and the one that running jobs may still read
OWNER = "claimflow.table"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its schema and, per part, its folder below the table's (one, `""`, without parts)."""

    version: int
    schema: T.StructType
    folders: dict[str, str]
    part_column: str | None = None
    widened: bool = False
    properties: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        values = json.loads(text)
        return cls(**{**values, "schema": T.StructType.fromJson(values["schema"])})


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in list_names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]


def _manifest_file(path: str, version: int) -> str:
    return f"{path}/{MANIFESTS}/{version:020d}.json"


def manifest(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> Manifest | None:
    """The current version of a table, or the one asked for; None for a folder without versions."""
    path = table_path(root, layer, name)
    if version is None:
        versions = _versions(spark, path)
        if not versions:
            return None
        version = versions[-1]
    return Manifest.from_json(read_small(spark, _manifest_file(path, version)))


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns followed by those that are new. A column keeps its type."""
    kinds = {f.name.lower(): f.dataType for f in old}
    for f in new:
        if kinds.get(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType(old.fields + [f for f in new if f.name.lower() not in kinds])


def _written(df: DataFrame, path: str, version: int, part_column: str | None) -> dict[str, str]:
    """Write a frame into a folder nobody knows yet; the folder of each part."""
    folder = f"_version={version}-{uuid.uuid4().hex[:12]}"
    if part_column is None:
        df.write.option("compression", STORED).parquet(f"{path}/{folder}")
        return {"": folder}
    df.write.option("compression", STORED).partitionBy(part_column).parquet(f"{path}/{folder}")
    names = [n for n in list_names(df.sparkSession, f"{path}/{folder}") if n.startswith(f"{part_column}=")]
    return {unquote(n.split("=", 1)[1]): f"{folder}/{n}" for n in names}


def _commit(spark: SparkSession, root: str, layer: str, name: str, new: Manifest, comment: str) -> None:
    path = table_path(root, layer, name)
    write_once(spark, _manifest_file(path, new.version), new.to_json())
    vacuum(spark, root, layer, name)
    _register(spark, path, layer, name, new, comment)


def publish(
    df: DataFrame, root: str, layer: str, name: str, comment: str, part_column: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Replace a table as a whole, register it as `<layer>.<name>` with its comment, and return it.

    The frame may read the table itself. With `part_column` the table is stored in one folder per value.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    version = max(_versions(spark, path), default=0) + 1
    folders = _written(df, path, version, part_column)
    _commit(spark, root, layer, name, Manifest(version, df.schema, folders, part_column, False, properties or {}), comment)
    return read_table(spark, root, layer, name)


def replace_parts(
    df: DataFrame, root: str, layer: str, name: str, comment: str, part_column: str,
    properties: dict[str, str] | None = None, emptied: Iterable[str] = (),
) -> DataFrame:
    """Replace the parts that the frame has rows for, keep the files of all others, and return the table.

    `emptied` parts lose their rows unless the frame has some. The frame may bring new columns. Properties are added
    to those of the table in the same step.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    old = manifest(spark, root, layer, name) or Manifest(0, df.schema, {}, part_column)
    if old.part_column != part_column:
        raise ValueError(f"{path} is stored by {old.part_column}, not by {part_column}")
    schema = _widened(old.schema, df.schema)
    folders = {p: f for p, f in old.folders.items() if p not in set(map(str, emptied))}
    folders.update(_written(df, path, old.version + 1, part_column))
    new = Manifest(
        old.version + 1, schema, folders, part_column, old.widened or len(schema) > len(old.schema),
        {**old.properties, **(properties or {})},
    )
    _commit(spark, root, layer, name, new, comment)
    return read_table(spark, root, layer, name)


def vacuum(spark: SparkSession, root: str, layer: str, name: str, keep: int = KEPT_VERSIONS) -> None:
    """Delete versions but the last `keep`, and folders of jobs that died before the current version."""
    path = table_path(root, layer, name)
    versions = _versions(spark, path)
    if not versions:
        return
    for version in versions[:-keep]:
        delete(spark, _manifest_file(path, version))
    used = {f for v in versions[-keep:] for f in manifest(spark, root, layer, name, v).folders.values()}
    tops = {f.split("/")[0] for f in used}
    for folder in list_names(spark, path):
        if not folder.startswith("_version=") or int(folder[9:].split("-")[0]) > versions[-1]:
            continue
        if folder not in tops:
            delete(spark, f"{path}/{folder}")
        elif folder not in used:
            for part in list_names(spark, f"{path}/{folder}"):
                if "=" in part and f"{folder}/{part}" not in used:
                    delete(spark, f"{path}/{folder}/{part}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def catalog_name(spark: SparkSession, root: str, layer: str, name: str) -> str:
    """`<layer>.<name>`, unless that names another root's table: then the database's name has a hash of the root."""
    owner = None
    if spark.catalog.tableExists(f"{layer}.{name}"):
        rows = spark.sql(f"SHOW TBLPROPERTIES `{layer}`.`{name}`").collect()
        owner = {r["key"]: r["value"] for r in rows}.get(OWNER)
        if owner != table_path(root, layer, name):
            return f"{layer}_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:8]}.{name}"
    return f"{layer}.{name}"


def _register(spark: SparkSession, path: str, layer: str, name: str, new: Manifest, comment: str) -> None:
    """A view of the version's folders. Folders with fewer columns than others cannot be read by one view.

    Names that start with an underscore are a table's own columns and a job's own layers; they are not shown.
    """
    if layer.startswith("_"):
        return
    database, _, entry = catalog_name(spark, path[: -len(f"/{layer}/{name}")], layer, name).partition(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_quoted(path[: -len(name) - 1])}")
    # A part column is in the folders' names only, which a view over some of them does not read.
    columns = ", ".join(f"`{f.name}`" for f in new.schema if not f.name.startswith("_") and f.name != new.part_column)
    if new.widened or not new.folders or not columns:
        spark.sql(f"DROP VIEW IF EXISTS `{database}`.`{entry}`")
        return
    folders = sorted(new.folders.values())
    files = f"{path}/{folders[0]}" if len(folders) == 1 else f"{path}/{{{','.join(folders)}}}"
    spark.sql(
        f"CREATE OR REPLACE VIEW `{database}`.`{entry}` COMMENT {_quoted(comment)}"
        f" TBLPROPERTIES ({_quoted(OWNER)} = {_quoted(path)}) AS SELECT {columns} FROM parquet.`{files}`"
    )


def read_table(
    spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType | None = None,
    parts: Iterable[str] | None = None, version: int | None = None,
) -> DataFrame:
    """A stored table as a batch. With a schema, files that lack some of its columns read NULL there.

    Of a partitioned table `parts` names the folders to read.
    """
    path, found = table_path(root, layer, name), manifest(spark, root, layer, name, version)
    if found is None:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    schema = schema or found.schema
    chosen = found.folders.keys() if parts is None else [p for p in dict.fromkeys(map(str, parts)) if p in found.folders]
    if not chosen:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if found.part_column is not None:
        reader = reader.option("basePath", path)
    return reader.parquet(*[f"{path}/{found.folders[p]}" for p in chosen]).select(*[f"`{c}`" for c in schema.fieldNames()])


def read_table_stream(
    spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A stored table as a stream: an append table as it grows, or a published one as it is now.

    `max_files` bounds a micro-batch.
    """
    path, found = table_path(root, layer, name), manifest(spark, root, layer, name)
    if found is not None:
        if found.part_column is not None:
            raise ValueError(f"{path} is replaced part by part; read it as a batch")
        path = f"{path}/{found.folders['']}"
    if schema is None:
        schema = read_table(spark, root, layer, name).schema
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_sql(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Run SQL in which each keyword names a frame as a table."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
