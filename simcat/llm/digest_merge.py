"""Exact deduplication by a tree merge of sorted digest runs.

A run is a sorted array of keys (SHA-256 of the normalised text, its length and a second, independent hash) with
the identifier that stays and the size of the group; every partition of the written digests forms one.
Runs are exchanged in rounds: in each round the runs whose numbers agree after division by ``FAN_IN`` meet, and a
multiway merge gives each key its place from its places in the other runs; equal keys become one, until one run is
left.  Digests only merge when length and second hash agree too.

The digest space is cut by leading bits, more of them each round as there are fewer runs, so that a group holds about
``RANGE_ROWS`` rows in every round: there are rows / ``RANGE_ROWS`` groups (at least as many as shuffle partitions).
A digest is one row per run however many copies there are.

Defined results: null text counts as empty and empty texts form one group; of equal texts the row
with the largest ``doc_id`` stays (null ids sort lowest); rows that repeat the id that stays are all
marked as kept by ``dedup`` and reduced to one by ``filter_documents``; extra columns are untouched, whatever their
names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import hot_join, lower_ascii, materialise, table, tasks_for, text_or_empty

FAN_IN = 8            # runs that meet in one merge
RANGE_ROWS = 100_000  # rows that a group holds in a round, about

RUN_SCHEMA = ("part int, run int, digest binary, n_bytes long, check long, keep_id long, "
              "group_size long")
PACKED = "part long, run int, keys binary, keep binary, size binary"
KEY = np.dtype("S48")  # digest, length and second hash, the numbers big-endian, so that keys sort as bytes


def _unite(keys: np.ndarray, keep: np.ndarray, size: np.ndarray):
    """Equal neighbours of a sorted run become one."""
    if not len(keys):
        return keys, keep, size
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.maximum.reduceat(keep, start), np.add.reduceat(size, start)


def merge_sorted(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Multiway merge of sorted runs (keys, keep, size) into one sorted run with each key once."""
    n = sum(len(r[0]) for r in runs)
    out = np.empty(n, KEY), np.empty(n, np.int64), np.empty(n, np.int64)
    for i, run in enumerate(runs):
        # a key's place: its own, and how many keys of the other runs come before it (ties by run)
        place = np.arange(len(run[0]))
        for j, other in enumerate(runs):
            if j != i:
                place = place + np.searchsorted(other[0], run[0], side="right" if j < i else "left")
        for column, values in zip(out, run):
            column[place] = values
    return _unite(*out)


def _chunks(run, bits: int):
    """The pieces of a sorted run by the leading ``bits`` of the digest: (piece, keys, keep, size)."""
    keys = np.ascontiguousarray(run[0])
    if not len(keys):
        return
    lead = keys.view(np.uint8).reshape(-1, KEY.itemsize)[:, :8].copy().view(">u8").ravel().astype(np.uint64)
    part = (lead >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for i, j in zip(at[:-1], at[1:]):
        yield int(part[i]), *(column[i:j].tobytes() for column in (keys, *run[1:]))


def _pack(bits: int):
    """Sorted runs of a partition's rows, cut by ``bits`` bits."""
    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            col = {name: batch.column(name) for name in batch.schema.names}
            digest = b"".join(d.ljust(32, b"\0") for d in col["digest"].to_pylist())
            key = np.zeros((batch.num_rows, KEY.itemsize), np.uint8)
            key[:, :32] = np.frombuffer(digest, np.uint8).reshape(-1, 32)
            for at, name in ((32, "n_bytes"), (40, "check")):
                number = col[name].to_numpy().astype(np.int64).astype(">i8")
                key[:, at:at + 8] = number.view(np.uint8).reshape(-1, 8)
            keys = key.reshape(-1).view(KEY)
            numbers = col["run"].to_numpy()
            rows = keys, col["keep_id"].to_numpy().astype(np.int64), col["group_size"].to_numpy().astype(np.int64)
            for number in np.unique(numbers).tolist():
                here = numbers == number
                found.setdefault(number, []).append([c[here] for c in rows])
        for number, parts in found.items():
            keys, keep, size = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(keys, kind="stable")
            for part, *packed in _chunks(_unite(keys[order], keep[order], size[order]), bits):
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int64()), "run": pa.array([number], pa.int32()),
                    **{n: pa.array([c], pa.binary()) for n, c in zip(("keys", "keep", "size"), packed)}})
    return run


def _merge(bits: int):
    """Merge the runs of one node; the result is cut for the next round."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        runs = [(np.frombuffer(k, KEY), np.frombuffer(i, np.int64), np.frombuffer(n, np.int64))
                for k, i, n in zip(pdf["keys"], pdf["keep"], pdf["size"])]
        rows = [(part, int(key[1]), *packed) for part, *packed in _chunks(merge_sorted(runs), bits)]
        return pd.DataFrame(rows, columns=["part", "run", "keys", "keep", "size"])
    return run


def _merge_last(packed: pa.Table) -> pa.Table:
    """Merge the runs of one node into rows, in the same Python worker."""
    keys, keep, size = merge_sorted([
        (np.frombuffer(k, KEY), np.frombuffer(i, np.int64), np.frombuffer(n, np.int64))
        for k, i, n in zip(*(packed.column(name).to_pylist() for name in ("keys", "keep", "size")))])
    raw = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, KEY.itemsize)
    digest = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(32), len(raw), [None, pa.py_buffer(raw[:, :32].tobytes())]).cast(pa.binary())
    number = lambda at: pa.array(
        raw[:, at:at + 8].copy().view(">i8").ravel().astype(np.int64), pa.int64())
    return pa.Table.from_pydict({
        "digest": digest, "n_bytes": number(32), "check": number(40),
        "keep_id": pa.array(keep, pa.int64()), "group_size": pa.array(size, pa.int64())})


def cuts(n_rows: int, n_runs: int, at_least: int) -> list[tuple[int, int]]:
    """(runs, leading bits) of each round: rows / ``RANGE_ROWS`` groups, but not under ``at_least``."""
    out, groups = [], max(1, at_least, math.ceil(n_rows / RANGE_ROWS))
    while n_runs > 1 or not out:
        nodes = math.ceil(n_runs / FAN_IN)
        out.append((n_runs, max(0, math.ceil(math.log2(groups / nodes)))))
        n_runs = nodes
    return out


def merge_runs(runs: DataFrame, n_runs: int, n_rows: int = 0) -> DataFrame:
    """One row per key of ``runs`` (columns of ``RUN_SCHEMA``, run < ``n_runs``): digest, n_bytes, check, keep_id,
    group_size."""
    rounds = cuts(n_rows, n_runs, int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    packed = runs.select("run", "digest", "n_bytes", "check", "keep_id", "group_size").mapInArrow(
        _pack(rounds[0][1]), PACKED)
    node = F.floor(F.col("run") / FAN_IN).cast("int").alias("node")
    for _, after in rounds[1:]:
        packed = packed.groupBy("part", node).applyInPandas(_merge(after), PACKED)
    return packed.groupBy("part", node).applyInArrow(
        _merge_last, "digest binary, n_bytes long, check long, keep_id long, group_size long")


# A null id takes part as the lowest value.
NULL_ID = -(1 << 63)


def digests(docs: DataFrame, text: str = "text"):
    """Columns of the normalised text: digest, n_bytes, check."""
    norm = lower_ascii(text_or_empty(text)).cast("binary")
    return [F.unhex(F.sha2(norm, 256)).alias("digest"),
            F.octet_length(norm).cast("long").alias("n_bytes"), F.xxhash64(norm).alias("check")]


def groups(rows: DataFrame) -> DataFrame:
    """One row per distinct text of ``rows`` (digest, n_bytes, check, doc_id, a written table):
    digest, n_bytes, check, keep_id, group_size."""
    size = rows.select(F.spark_partition_id().alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.max("run").alias("last")).first()
    n_runs = (size["last"] or 0) + 1
    first = rows.select(
        F.lit(0).alias("part"), F.pmod(F.spark_partition_id(), F.lit(n_runs)).alias("run"), "digest", "n_bytes", "check",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"))
    return merge_runs(first, n_runs, size["n"])


def _dedup(docs: DataFrame, text: str) -> tuple[DataFrame, int]:
    """The rows of ``dedup`` and their number."""
    rows = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                   *digests(docs, text)), "digests")
    merged = materialise(groups(rows), "digest-groups")
    key = ["digest", "n_bytes", "check"]
    total = rows.count()
    out = hot_join(rows, merged, key, total)
    keep = F.when(F.col("keep_id") == NULL_ID, F.lit(None).cast("long")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), "group_size",
                      F.col("doc_id").eqNullSafe(keep).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256")), total


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs``."""
    return _dedup(docs, text)[0]


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one exchange of the texts.

    Repeated rows (same ``doc_id``, same text) are reduced to one of them.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key")
    marked, total = _dedup(docs, "text")
    keep = marked.filter("kept").select(key, F.unhex("text_sha256").alias("sha")).distinct()
    tagged = docs.select(key, F.unhex(F.sha2(lower_ascii(text_or_empty()).cast("binary"), 256)).alias("sha"),
                         F.struct("*").alias("row"))
    return (tagged.join(keep, ["key", "sha"], "left_semi")
            .dropDuplicates(["key", "sha"]).select("row.*").coalesce(tasks_for(docs.sparkSession, total)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d"""
