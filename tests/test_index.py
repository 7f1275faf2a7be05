import json
import os
import tempfile

from simcat.config import Config
from simcat.index import SimilarityIndex


def test_index_from_ldjson_search_recall_save_load(spark):
    d = tempfile.mkdtemp(prefix="simcat-idx-", dir="/tmp")
    with open(os.path.join(d, "dump.ldjson"), "w") as fh:
        for i in range(40):
            kurta = i < 20
            fh.write(json.dumps({
                "uniq_id": f"p{i:03d}", "product_name": ("Cotton Kurta " if kurta else "Slim Shirt ") + str(i),
                "brand": "biba" if kurta else "pantaloons", "sales_price": "500.00" if kurta else "250.00",
                "rating": "4.0", "browsenode": "k" if kurta else "s",
                "sales_rank_in_child_category": "{'Kurtas': '#1'}" if kurta else "{'Shirts': '#2'}",
                "meta_keywords": "kurta cotton" if kurta else "shirt slim"}) + "\n")
        fh.write("not json\n")
    idx = SimilarityIndex.from_ldjson(spark, d, Config(tfidf_min_df=1, ann_cells=3, ann_nprobe=3))
    r = idx.search("p000", 5).toPandas()
    assert len(r) == 5 and set(r.child_category) == {"Kurtas"}
    assert idx.find_similar_products("p000", 5) == list(r.sort_values("rank").product_id)
    assert idx.recall_at_k(5, sample=10) == 1.0          # every cell probed
    assert idx.stats().first()["n_products"] == 40
    path = os.path.join(d, "index")
    idx.save(path)
    again = SimilarityIndex.load(spark, path, idx.cfg)
    assert again.find_similar_products("p000", 5) == idx.find_similar_products("p000", 5)
