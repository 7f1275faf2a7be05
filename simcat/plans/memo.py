"""Reuse of built plans and materialised tables within one session.

Building a DataFrame from Python costs one JVM round trip per expression node,
and a fitted feature table is an index meant to serve many queries.  Both are
kept per (session, folder and state of its files, parameters) for the life of the session.
"""

from __future__ import annotations

_MEMO: dict = {}


def folder_state(spark, path: str) -> tuple:
    """Name, size and time of what lies in a folder of tables (one listing; parts of a table too)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((s.getPath().getName(), s.getLen(), s.getModificationTime())
                 for s in fs.listStatus(root))


def memo(spark, key: tuple, build):
    """``key`` is (kind, folder, ...); a changed folder is built anew."""
    k = (id(spark), spark.sparkContext.applicationId, folder_state(spark, key[1])) + key
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def clear() -> None:
    _MEMO.clear()
