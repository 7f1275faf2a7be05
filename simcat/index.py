"""One object for the whole flow: build from raw records, search, measure, save, load.

A thin facade over the Spark operators (normalise -> features -> optional ANN
cells); every method returns DataFrames except the id-list convenience form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simcat.config import Config
from simcat.operators import ann as A
from simcat.operators import features as FT
from simcat.operators import normalise as N
from simcat.operators import search as S


@dataclass
class SimilarityIndex:
    features: DataFrame
    model: FT.FeatureModel
    ann: A.AnnIndex | None
    cfg: Config

    @classmethod
    def from_raw(cls, raw: DataFrame, cfg: Config = Config(), build_ann: bool = True):
        feats, model = FT.build_features(N.normalise(raw, cfg.weight_sentinel), cfg)
        ann = A.build(feats, cells=cfg.ann_cells, dims=cfg.ann_dims, seed=cfg.ann_seed) \
            if build_ann else None
        return cls(feats, model, ann, cfg)

    @classmethod
    def from_ldjson(cls, spark: SparkSession, path: str, cfg: Config = Config(),
                    build_ann: bool = True):
        from simcat.sources.ldjson import scan_ldjson
        from simcat.streaming.ingest import DUMP_COLUMNS
        return cls.from_raw(scan_ldjson(spark, path, DUMP_COLUMNS), cfg, build_ann)

    def _ids(self, ids) -> DataFrame:
        if isinstance(ids, DataFrame):
            return ids
        ids = [ids] if isinstance(ids, str) else list(ids)
        return self.features.sparkSession.createDataFrame([(i,) for i in ids], "product_id string")

    def search(self, ids, k: int = 10, backend: str = "exact") -> DataFrame:
        return S.search(self.features, self._ids(ids), k, backend, self.ann, self.cfg.ann_nprobe,
                        max_k=self.cfg.max_num_similar)

    def find_similar_products(self, product_id: str, num_similar: int = 10) -> list[str]:
        return S.find_similar_products(self.features, product_id, num_similar,
                                       self.cfg.max_num_similar)

    def all_pairs(self, k: int = 10) -> DataFrame:
        return S.all_pairs(self.features, k, block_rows=self.cfg.block_rows)

    def recall_at_k(self, k: int = 10, sample: int = 200, seed: int = 42) -> float:
        """Approximate vs exact over a seeded sample; 1.0 when there is no ANN index."""
        if self.ann is None:
            return 1.0
        q = S.lookup(self.features, A.sample_ids(self.features, sample, seed))
        n = q.count()
        ex = S.topk(q, self.features, k, block_rows=self.cfg.block_rows)
        ap = A.search(q, self.ann, k, self.cfg.ann_nprobe, self.cfg.block_rows)
        return float(A.recall_at_k(ex, ap, n, k).first()["recall"])

    def stats(self) -> DataFrame:
        dims = self.model.block_dims()
        return self.features.agg(F.count("*").alias("n_products")).select(
            "n_products",
            F.lit(len(self.ann.centers) if self.ann is not None else 0).cast("bigint").alias("ann_cells"),
            *[F.lit(int(v) if v else 0).cast("bigint").alias(f"dims_{b}") for b, v in dims.items()])

    def save(self, path: str) -> None:
        from simcat.operators.index_store import save_index
        save_index(path, self.features, self.model, self.ann, self.cfg)

    @classmethod
    def load(cls, spark: SparkSession, path: str, cfg: Config | None = None):
        """With the configuration it was saved with, unless another is given."""
        from simcat.operators.index_store import load_index
        feats, model, ann, saved = load_index(spark, path)
        return cls(feats, model, ann, cfg or saved)
