"""Near-duplicate components against brute force over all pairs."""

import itertools
import random
import re

import numpy as np

import corpus_pipeline
from simcat.llm import circulant as C
from simcat.llm.common import LOWER_TABLE


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER_TABLE))
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def expected(rows):
    sets = [(i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, p), (b, q) in itertools.combinations(sets, 2):
        if p and q and 100 * len(p & q) >= 85 * len(p | q):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
    got = C.cluster(docs.repartition(4)).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_edge_cases(spark):
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c"),
                  (7, "a\x0bb"), (8, "ä b"), (9, "Ä b"), (10, "one two three four five six"),
                  (11, "one two three four five six"), (12, " ".join(f"t{i}" for i in range(50_000)))])


def test_empty_table(spark):
    assert C.cluster(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chains_and_variants(spark):
    rng = random.Random(3)
    rows, ident = [], 0
    for family in range(12):
        base = words(rng, 80)
        for _ in range(12):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10 ** 6)}"
            rows.append((ident, " ".join(text)))
            ident += 1
    chain = words(rng, 120)
    for _ in range(25):                   # each a step from the one before: one long component
        chain = list(chain)
        chain[rng.randrange(120)] = f"c{rng.randrange(10 ** 6)}"
        rows.append((ident, " ".join(chain)))
        ident += 1
    passage = words(rng, 40)              # a passage that many different documents share
    for _ in range(40):
        rows.append((ident, " ".join(passage + words(rng, rng.randrange(5, 60)))))
        ident += 1
    rng.shuffle(rows)
    check(spark, rows)


def test_signature_is_the_minimum_over_shifted_permutations():
    s = C.shingle_set("the quick brown fox jumps over the lazy dog again")
    t = C.shingle_set("a completely different text of some more words than that one")
    both = C.signatures([s, t])
    assert (both[0] == C.signatures([s])[0]).all() and (both[1] == C.signatures([t])[0]).all()
    union = C.signatures([np.union1d(s, t)])[0]
    assert (union == np.minimum(both[0], both[1])).all()


def test_word_hashes_follow_white_space_and_case():
    a = C.word_hashes("Ab  cd\tef")
    assert (a == C.word_hashes(" aB cd\nEF ")).all() and len(set(a.tolist())) == 3


def test_filter_keeps_one_of_each(spark):
    docs = spark.createDataFrame([(2, "x y z", 1), (1, "X y z", 2), (3, None, 3), (3, None, 3)],
                                 "doc_id long, text string, n int")
    kept = C.filter_documents(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_null_ids_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (7, text + " x"), (7, "other words"), (9, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in C.cluster(docs).collect()}
    assert got == {(None, 56): (None, True), (7, 57): (None, False), (7, 1): (None, False), (9, 1): (9, True)}


def test_rows_without_an_id_of_their_own_are_told_apart_by_text(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(None, one, 1), (None, two, 2), (None, one + " x", 3), (7, three, 4), (7, "other words", 5),
            (8, two + " x", 6), (9, three + " x", 7), (9, None, 8), (9, "", 9), (None, " ", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = {r["n"] for r in C.filter_documents(docs.repartition(4)).collect()}
    assert len(kept & {1, 3}) == 1 and kept - {1, 3} == {2, 4, 5, 8, 9, 10}
    got = C.cluster(docs, one_per_id=False).collect()
    assert sum(r["kept"] for r in got) == 7
    assert {(r["doc_id"], r["component_id"]) for r in got if r["n_shingles"] == 57} == {
        (None, None), (8, None), (9, 7)}


def test_many_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text)] * 300 + [(None, f"{text} {i}") for i in range(40)] + [(5, "alone")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] or 0 for r in C.filter_documents(docs).collect()) == [0, 5]


def test_pairs_between_the_thresholds(spark):
    rng = random.Random(5)
    rows = []
    for family in range(6):
        base = words(rng, 150)
        near = list(base)
        for at in (30, 70, 110):          # 131 of 161 shingles are shared: 0.81
            near[at] = f"n{family}"
        rows += [(2 * family, " ".join(base)), (2 * family + 1, " ".join(near))]
    assert all(0.8 <= len(grams(a) & grams(b)) / len(grams(a) | grams(b)) < 0.85
               for (_, a), (_, b) in zip(rows[::2], rows[1::2]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in C.filter_documents(docs).collect()) == list(range(12))
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()
                  ) == list(range(0, 12, 2))


def labels_of(spark, edges, monkeypatch=None):
    rounds = []
    if monkeypatch:
        real = C._small_star
        monkeypatch.setattr(C, "_small_star", lambda e: rounds.append(1) or real(e))
    got = C.components(spark.createDataFrame(edges, "a long, b long").repartition(3))
    return {r["id"]: r["label"] for r in got.collect()}, len(rounds)


def plain_labels(edges):
    up = {v: v for e in edges for v in e}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {v: root(v) for v in up}


def test_a_shuffled_path_takes_few_rounds(spark, monkeypatch):
    order = list(range(1000))
    random.Random(3).shuffle(order)
    got, rounds = labels_of(spark, list(zip(order, order[1:])), monkeypatch)
    assert got == dict.fromkeys(range(1000), 0) and rounds <= 15


def test_components_of_random_links_equal_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(-40, 300), rng.randrange(-40, 300)) for _ in range(180)]
    edges += [(500, 500), (7, 7), edges[0], edges[0][::-1]] + [(1000, 1001 + i) for i in range(150)]
    assert labels_of(spark, edges)[0] == plain_labels(edges)


def test_components_without_links(spark):
    assert labels_of(spark, [])[0] == {} and labels_of(spark, [(4, 4)])[0] == {4: 4}


def test_rows_of_the_components_id_are_kept(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(7, text), (7, text + " x"), (8, text + " y")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in C.cluster(docs, one_per_id=False).collect())
    assert got == [(7, 7, True), (7, 7, True), (8, 7, False)]
    assert C.filter_documents(docs).count() == 1


def test_nothing_is_broadcast_by_an_estimate(spark, monkeypatch):
    rng = random.Random(10 ** 6)
    rows = [(i, " ".join(words(random.Random(i // 2), 60) + [f"v{i}"])) for i in range(400)]
    rows += [(400 + i, " ".join(words(rng, 60))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plans, real = {}, C.materialise

    def seen(df, label, *more):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label, *more)
    monkeypatch.setattr(C, "materialise", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    out = C.cluster(docs, one_per_id=False)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert plans["members"] and plans["sets"] and plans["star"]
    last = out._jdf.queryExecution().executedPlan().toString()
    for label, some in [*plans.items(), ("result", [last])]:
        for plan in some:          # hot keys only, of which there are few; both halves of a hot join read them
            assert plan.count("BroadcastExchange") <= 2 * (label in ("named", "result"))
    assert {r["component_id"] for r in out.collect()} == {*range(0, 400, 2), *range(400, 500)}
