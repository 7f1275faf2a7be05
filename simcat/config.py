"""Tunables with their defaults.

The defaults are the values the original service ships with; callers pass a
modified copy (``dataclasses.replace``) for small data or experiments.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Block weights before renormalisation (category, text, numeric,
# brand, colour), in that order.
DEFAULT_WEIGHTS = {
    "category": 0.35,
    "text": 0.30,
    "numeric": 0.20,
    "brand": 0.10,
    "colour": 0.05,
}

BLOCKS = ("category", "text", "numeric", "brand", "colour")


@dataclass(frozen=True)
class Config:
    weights: dict = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    # text block
    tfidf_max_features: int = 4096
    tfidf_min_df: int = 3
    stop_words: tuple | None = None  # None -> Spark ML's English list (simcat.functions.text)
    svd_components: int = 256      # <= 0 keeps the raw TF-IDF space
    svd_seed: int = 42
    svd_oversample: int = 10
    svd_power_iters: int = 5
    # vocabularies
    top_n_brands: int = 300
    top_n_colours: int = 60
    # weight values at or above this (grams) are the missing-data sentinel
    weight_sentinel: float = 1_000_000.0
    # search
    max_num_similar: int = 100
    block_rows: int = 2048          # rows per block or query chunk in exact scoring
    # approximate search (inverted-file cells)
    ann_cells: int = 0              # 0 -> about sqrt(n), at most ann.MAX_CELLS
    ann_nprobe: int = 32            # recall@10 0.989 on the sf0.1 catalogue (see README)
    ann_dims: int = 64              # random-projection width used for the cells
    ann_seed: int = 42

    def normalised_weights(self) -> dict:
        total = float(sum(self.weights.get(b, 0.0) for b in BLOCKS))
        if total <= 0:
            raise ValueError("no feature block has a weight above zero")
        return {b: float(self.weights.get(b, 0.0)) / total for b in BLOCKS}
