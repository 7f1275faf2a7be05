"""Persist a built index as Parquet and load it back.

Layout under ``path``:

* ``features/`` — the feature table; with an ANN index it is partitioned by
  ``cell`` so a probe of a cell reads only that cell's files (partition pruning).
* ``model/``    — one row: the fitted statistics as JSON (medians, means,
  scales, vocabularies, weights; all bounded in size).
* ``svd/``      — one row per SVD component (k rows), when the text block is reduced.
* ``cells/``    — one row per ANN cell centre.

Everything is written with Spark, so ``path`` may be any shared file system.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simcat.config import Config
from simcat.operators.features import FeatureModel

SPLITS = 4      # tasks over which one cell may be written


def save_index(path: str, features: DataFrame, model: FeatureModel, ann=None,
               cfg: Config = Config(), mode: str = "overwrite") -> None:
    spark = features.sparkSession
    if ann is not None:
        # a cell's rows meet in a few tasks (large cells in several), not in files of every task
        sub = F.pmod(F.xxhash64(ann.spec.id_col), F.lit(SPLITS))
        writer = ann.cells.repartition("cell", sub).write.mode(mode).partitionBy("cell")
    else:
        writer = features.write.mode(mode)
    writer.parquet(os.path.join(path, "features"))
    meta = {"weights": model.weights, "medians": model.medians, "means": model.means,
            "scales": model.scales, "brands": model.brands, "colours": model.colours,
            "vocab": model.vocab, "n_docs": model.n_docs,
            "svd_k": model.svd.k if model.svd is not None else 0,
            "svd_explained": model.svd.explained_variance_ratio if model.svd is not None else None,
            "svd_variance": [float(x) for x in model.svd.explained_variance] if model.svd is not None else [],
            "svd_total": model.svd.total_variance if model.svd is not None else None,
            "stop_words": model.stop_words, "config": asdict(cfg),
            "ann_dims": ann.dims if ann is not None else None,
            "ann_spec": asdict(ann.spec) if ann is not None else None}
    spark.createDataFrame([(json.dumps(meta),)], "model string").coalesce(1) \
         .write.mode(mode).parquet(os.path.join(path, "model"))
    if model.svd is not None:
        rows = [(i, [float(x) for x in row]) for i, row in enumerate(model.svd.components)]
        spark.createDataFrame(rows, "i int, v array<double>").write.mode(mode) \
             .parquet(os.path.join(path, "svd"))
    if ann is not None:
        rows = [(i, [float(x) for x in row]) for i, row in enumerate(ann.centers)]
        spark.createDataFrame(rows, "i int, v array<double>").write.mode(mode) \
             .parquet(os.path.join(path, "cells"))


def _tuples(v):
    """JSON lists back to tuples."""
    return tuple(_tuples(x) for x in v) if isinstance(v, list) else v


def _matrix(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(path).orderBy("i").collect()     # k or #cells rows
    return np.array([r["v"] for r in rows])


def load_index(spark: SparkSession, path: str):
    """Returns (features DataFrame, FeatureModel, AnnIndex or None, the Config it was built with)."""
    from simcat.operators.ann import AnnIndex
    from simcat.operators.search import RankSpec
    from simcat.operators.svd import SvdModel
    meta = json.loads(spark.read.parquet(os.path.join(path, "model")).first()["model"])
    model = FeatureModel(weights=meta["weights"], medians=meta["medians"], means=meta["means"],
                         scales=meta["scales"], brands=meta["brands"], colours=meta["colours"],
                         vocab=[tuple(v) for v in meta["vocab"]], n_docs=meta["n_docs"],
                         stop_words=tuple(meta["stop_words"]) if meta["stop_words"] is not None else None)
    if meta["svd_k"]:
        model.svd = SvdModel(components=_matrix(spark, os.path.join(path, "svd")), k=meta["svd_k"],
                             explained_variance_ratio=meta["svd_explained"],
                             explained_variance=np.array(meta["svd_variance"]),
                             total_variance=meta["svd_total"])
    feats = spark.read.parquet(os.path.join(path, "features"))
    ann = None
    if meta["ann_dims"]:
        ann = AnnIndex(centers=_matrix(spark, os.path.join(path, "cells")),
                       cells=feats.withColumn("cell", F.col("cell").cast("int")),
                       dims=meta["ann_dims"],
                       spec=RankSpec(**{k: _tuples(v) for k, v in meta["ann_spec"].items()}))
    config = {k: _tuples(v) for k, v in meta["config"].items()}
    return feats, model, ann, Config(**config)
