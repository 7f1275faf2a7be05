"""Ranked lexical search against a plain scorer, over edge cases and small blocks."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from simcat.llm import lexical as L
from simcat.llm.common import LOWER_TABLE, shared_path

PLAIN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return PLAIN.findall((text or "").translate(LOWER_TABLE))


def brute(docs, items, k=10):
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n_all, l_all = len(found), sum(len(t) for _, t in found)
    out = []
    for item_id, text in items:
        terms = sorted(set(plain_terms(text)))
        weight = {w: math.floor(1000 * math.log((2 * n_all + 2) / (2 * sum(w in t for _, t in found) + 1)))
                  for w in terms if any(w in t for _, t in found)}
        scored = []
        for i, t in found:
            m = 10 + (90 * len(t) * n_all) // l_all
            s = sum(weight[w] * ((10 ** 9 * t.count(w)) // (1000 * t.count(w) + 8 * m)) for w in terms if w in t)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def run(spark, docs, items, parts=3, **kw):
    path = shared_path(spark, "test-index")
    L.build(spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, terms string")
            .repartition(parts), path)
    asked = L.items_of(spark.createDataFrame([(i, t, 1) for i, t in items],
                                             "item_id string, text string, doc_id int").repartition(2))
    rows = L.search(spark, path, asked, **kw).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, rows), key=repr)


EDGE = [(1, "The cat sat"), (2, None), (3, ""), (4, "  ,.; "), (5, "CAT cat dog"), (6, "ÀÉ naïve cat_dog 42"),
        (None, "the cat sat"), (7, "the cat sat"), (7, "the cat sat"), (8, "日本 東京 cat"), (9, "word " * 60_000)]
ASKED = [("a", "cat dog cat"), ("b", None), (None, "Àé 42"), ("a", "the word"), ("c", "nothing known"), ("d", "東京"),
         ("e", "")]


@pytest.mark.parametrize("parts", [1, 4])
def test_edges_equal_the_plain_scorer(spark, parts):
    assert run(spark, EDGE, ASKED, parts) == brute(EDGE, ASKED)


def test_random_texts_in_many_blocks_and_chunks(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 80)))) for i in range(1500)]
    items = [(str(i), " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)]
    want = brute(docs, items)
    assert run(spark, docs, items, 2) == want
    monkeypatch.setattr(L, "BLOCK_DOCS", 130)
    assert run(spark, docs, items, 2, chunk_bytes=200) == want


def test_blocks_skip_most_postings_of_long_lists(spark):
    """Later runs of a block are not scored once their bound is below the k-th score."""
    docs = [(i, "common rare" if i < 20 else "common " + "filler " * (5 + i % 7)) for i in range(2000)]
    b = L.Builder()
    for i, t in docs:
        b.add(i, t.encode())
    row, weights = b.block(), {b"common": 3, b"rare": 4000}
    block = L.Block(row, weights, len(docs), 15_000)
    assert set(block.long) == {b"common"} and set(block.short) == {b"rare"}
    seen = []
    real = L.Block.part_score
    block.part_score = lambda tf, m: seen.append(len(tf)) or real(tf, m)
    top = L.Top(10)
    block.answer([b"common", b"rare"], top)
    assert sum(seen) <= 2 * L.RUN and sorted(d for _, d in top.rows()) == list(range(10))


def test_empty_tables(spark):
    assert run(spark, [], ASKED, 1) == []
    assert run(spark, EDGE, [], 1) == []
    assert run(spark, [(1, None), (2, " ")], ASKED, 1) == []
