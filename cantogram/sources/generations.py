"""Datasets in generations: a folder for each write, and one pointer that says which of them counts.

Below a dataset's path, ``_generation-<id>`` holds the files of one write, and an empty file
``_current-<number>-<id>`` points to it; the highest number counts. Creating that file is the whole switch, a single step on
every store that Spark writes to, without a rename. Whatever breaks off before it leaves the old rows, whatever breaks off
after it has the new ones: a reader sees either all of the old rows or all of the new ones. Nothing has to be put right before the next
read; the next write clears what an interrupted one has left.

The generation before the current one stays until the next switch, so that readers that have begun can finish. A dataset has one
writer at a time. A plain folder of files counts as the oldest generation.

A saved table is a view, the pointer, over a table for each generation, which keeps schema, partitions and buckets.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_FOLDER, _POINTER = "_generation-", "_current-"
_TABLE = re.compile(r"(.*)__generation_([0-9a-f]{32})")


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _delete(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def _pointers(names: list[str]) -> list[tuple[int, str]]:
    """(number, id) of the pointers, the current one last."""
    marks = [n[len(_POINTER) :].split("-", 1) for n in names if n.startswith(_POINTER)]
    return sorted((int(number), key) for number, key in marks)


def _plain(names: list[str]) -> list[str]:
    return [n for n in names if not n.startswith(("_", "."))]


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the current rows of a dataset; a plain folder is its own."""
    pointers = _pointers(_names(spark, path))
    return f"{path}/{_FOLDER}{pointers[-1][1]}" if pointers else path


def begin(spark: SparkSession, path: str) -> str:
    """The id of a new generation. What an interrupted write has left goes first."""
    names = _names(spark, path)
    known = {key for _, key in _pointers(names)}
    for name in names:
        if name.startswith(_FOLDER) and name[len(_FOLDER) :] not in known:
            _delete(spark, f"{path}/{name}")
    return uuid.uuid4().hex


def folder(path: str, key: str) -> str:
    return f"{path}/{_FOLDER}{key}"


def abandon(spark: SparkSession, path: str, key: str) -> None:
    """Remove a generation that was not finished."""
    _delete(spark, folder(path, key))


def switch(spark: SparkSession, path: str, key: str) -> None:
    """Make a finished generation the current one."""
    pointers = _pointers(_names(spark, path))
    number = pointers[-1][0] + 1 if pointers else 0
    files, where = _files(spark, f"{path}/{_POINTER}{number:012d}-{key}")
    if not files.createNewFile(where):
        raise OSError(f"cannot create {where}")


def clear(spark: SparkSession, path: str) -> None:
    """Remove what is older than the generation before the current one."""
    names = _names(spark, path)
    pointers = _pointers(names)
    for number, key in pointers[:-2]:
        _delete(spark, f"{path}/{_POINTER}{number:012d}-{key}")
        abandon(spark, path, key)
    if len(pointers) > 1:
        for name in _plain(names):
            _delete(spark, f"{path}/{name}")


# Tables


def table_of(name: str, key: str) -> str:
    return f"{name}__generation_{key}"


def is_generation(name: str) -> bool:
    """Whether a catalog name is that of one generation, which users reach by the table's own name."""
    return _TABLE.fullmatch(name) is not None


def _generations(spark: SparkSession, name: str) -> set[str]:
    database, short = name.rsplit(".", 1)
    found = (_TABLE.fullmatch(t.name) for t in spark.catalog.listTables(database, f"{short}__generation_*"))
    return {m[2] for m in found if m and m[1] == short.lower()}


def pointed(spark: SparkSession, name: str) -> list[str]:
    """Ids of the current generation of a saved table and of the one before it, as far as there are any."""
    if not spark.catalog.tableExists(name):
        return []
    return (spark.catalog.getTable(name).description or "").split()


def begin_table(spark: SparkSession, name: str) -> None:
    """Drop the generations that an interrupted load has left; a plain table of that name becomes a generation.

    That first switch alone has a moment without the name.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        old = uuid.uuid4().hex
        spark.sql(f"ALTER TABLE {name} RENAME TO {table_of(name, old)}")
        switch_table(spark, name, old)
    kept = set(pointed(spark, name))
    for key in _generations(spark, name) - kept:
        spark.sql(f"DROP TABLE IF EXISTS {table_of(name, key)}")


def switch_table(spark: SparkSession, name: str, key: str) -> None:
    """Let the name stand for a generation: one change of the catalog."""
    last = [k for k in pointed(spark, name)[:1] if k != key]
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{' '.join([key, *last])}' AS SELECT * FROM {table_of(name, key)}")


def clear_table(spark: SparkSession, name: str) -> None:
    """Drop what is older than the generation before the current one."""
    kept = set(pointed(spark, name))
    for key in _generations(spark, name) - kept:
        spark.sql(f"DROP TABLE IF EXISTS {table_of(name, key)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a saved table with all its generations."""
    if "." not in name:
        name = f"{spark.catalog.currentDatabase()}.{name}"
    keys = _generations(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for key in keys:
        spark.sql(f"DROP TABLE IF EXISTS {table_of(name, key)}")
