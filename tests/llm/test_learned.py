"""Learned operators: held-out accuracy on invented texts, automata by brute force, edge cases."""

import random
import zlib

import numpy as np
import pytest

from simcat.llm import byte_cnn as N, pu_quality as Q, toxicity as T


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def fold(ident, m):
    return zlib.crc32(str(ident).encode()) % m


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    rng = random.Random(0)
    entries = [("scum", False), ("idiot", False), ("worthless", False), ("bad", False), ("prefix", True)]
    lexicon = T.Lexicon(entries)
    for _ in range(6000):
        word = list(rng.choice(entries)[0])
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randrange(0, 2)] = rng.choice(["", "a", "x", "t"])
        word = "".join(word)
        near = {}
        for e, (term, stem) in enumerate(entries):
            if stem:
                d = min(distance(word[:k], term) for k in range(len(word) + 1))
            else:
                d = distance(word, term)
            if d <= lexicon.limit[e]:
                near[e] = d
        got = lexicon.match(word)
        assert (got is None) == (not near), word
        if got:
            assert got[1] == min(near.values()) and near[got[0]] == got[1], word


def toxic_tables(spark, n=900):
    rng = random.Random(1)
    bad = ["grobzak", "flimwort", "dunkelpfeif"]
    docs, labels = [], []
    for i in range(n):
        text = words(rng, "abcdeghilmnorst", 60).split()
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(3):
                term = rng.choice(bad)
                if rng.random() < 0.3:
                    at = rng.randrange(len(term))
                    term = term[:at] + "1" + term[at + 1:]
                text.insert(rng.randrange(60), term)
        docs.append((i, " ".join(text), "en"))
        labels.append((i, 1, int(toxic)))
    docs += [(n, None, None), (n + 1, "", "en"), (n + 2, "... !!", None)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels + [(3, None, None), (None, 1, 1)],
                                  "doc_id long, quality int, toxic int"), dict((i, t) for i, _, t in labels))


def test_toxicity_held_out(spark):
    docs, labels, truth = toxic_tables(spark)
    model = T.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model, ["doc_id"]).collect()}
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in truth if fold(i, T.FOLDS) == T.HELD_OUT]
    right = sum((got[i] >= T.CUT) == bool(truth[i]) for i in held)
    assert right / len(held) > 0.95
    assert got[900] == got[901] == got[902] < T.CUT
    kept = T.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < T.CUT}


def test_words_of_a_copied_text_are_no_lexicon(spark):
    docs, labels, _ = toxic_tables(spark, 600)
    rng = random.Random(8)
    copied = words(rng, "pqvwxyz", 80).split() + ["grobzak", "unusuallylongword"]
    more = []
    for i in range(2000, 2080):           # near copies: one word differs
        text = list(copied)
        text[rng.randrange(80)] = f"edit{i}"
        more.append((i, " ".join(text), "en"))
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(i, 0, 1) for i, *_ in more], labels.schema))
    entries, _, _ = T.fit(docs, labels)
    assert "grobzak" in {t for t, _ in entries}
    assert not {t for t, _ in entries} & set(copied[:80])


def test_labels_of_the_held_out_fold_are_never_used(spark):
    docs, labels, truth = toxic_tables(spark, 400)
    from pyspark.sql import functions as F
    from simcat.llm.common import crc_mod
    flipped = labels.withColumn("toxic", F.when(crc_mod(F.col("doc_id"), T.FOLDS) == T.HELD_OUT,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit(docs, labels) == T.fit(docs, flipped)


def test_quotation_counts_less():
    scanner = T.Scanner(T.Lexicon([("idiot", False)]))
    assert scanner.hits("you are an idiot") == {(0, 0, False, True)}
    assert scanner.hits('he wrote the word "idiot" in a letter') == {(0, 0, True, True)}
    assert scanner.hits("Idi0t! and idiotic") == {(0, 1, False, True)}
    assert scanner.hits(None) == scanner.hits("") == set()


def test_context_is_words_not_characters():
    scanner = T.Scanner(T.Lexicon([("idiot", 0)]))
    long = " ".join(["extraordinarily" * 3] * 7)
    assert scanner.hits(f"he wrote {long} idiot") == {(0, 0, True, True)}
    assert scanner.hits(f"he wrote {long} {long} idiot") == {(0, 0, False, True)}


def test_a_stem_may_need_several_words(spark):
    """A stem that clean texts of one language have once, and toxic ones several times."""
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(1200):
        rare = i % 8 == 0
        text = words(rng, "uvwxyz" if rare else "abcdeghi", 50).split()
        toxic = rng.random() < 0.12
        stem = "bomente" if rare else "grobz"
        for _ in range(rng.randrange(3, 6) if toxic else int(rare and rng.random() < 0.3)):
            text.insert(rng.randrange(50), stem + "".join(rng.choice("aeiourst") for _ in range(4)))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    # repeated rows, a very long text
    docs += [docs[0], docs[0], (1200, docs[1][1] * 3000)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit(docs_df, labels_df)
    assert dict(model[0])["bomente"] > 1
    rows = T.score(docs_df, model, ["doc_id"]).collect()
    assert len(rows) == 1203 and len({r["score"] for r in rows if r["doc_id"] == 0}) == 1
    got = {r["doc_id"]: r["score"] for r in rows}
    held = [(i, y) for i, _, y in labels if fold(i, T.FOLDS) == T.HELD_OUT]
    for rare in (True, False):
        of = [(i, y) for i, y in held if (i % 8 == 0) == rare]
        assert sum((got[i] >= T.CUT) == bool(y) for i, y in of) / len(of) > 0.97


def test_no_labels(spark):
    docs, labels, _ = toxic_tables(spark, 20)
    none = labels.limit(0)
    assert T.fit(docs, none) == ([], {}, 0.0)
    assert {r["score"] for r in T.score(docs, T.fit(docs, none), ["doc_id"]).collect()} == {0.0}
    assert Q.fit(docs, none) is None
    assert {r["score"] for r in Q.score(docs, None).collect()} == {0.5}
    assert N.fit(docs.limit(0)) is None
    assert {tuple(r) for r in N.predict(docs, None).select("lang_pred", "score").collect()} == {("und", 0.0)}
    assert T.score(docs.limit(0), T.fit(docs, none), ["doc_id"]).count() == 0


def test_quality_held_out(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1200):
        good = rng.random() < 0.75
        text = words(rng, "abcdefghiklmnoprstuw", 60)
        if not good:
            text = [text.upper() + "!!", " | ".join(text.split()), text.replace(" ", "### "),
                    (text.split()[0] + " ") * 50][i % 4]
        docs.append((i, text, "clash"))
        labels.append((i, int(good), 0))
    docs += [(1200, None, "clash"), (1201, "", "clash"), (1202, "x" * 400_000, "clash")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in Q.score(docs_df, Q.fit(docs_df, labels_df)).collect()}
    assert len(got) == 1203 and all(0 <= s <= 1 for s in got.values()) and got[1200] == got[1201]
    held = [(i, y) for i, y, _ in labels if fold(i, Q.FOLDS) == Q.HELD_OUT]
    assert sum((got[i] >= Q.CUT) == bool(y) for i, y in held) / len(held) > 0.95
    assert Q.score(docs_df.limit(0), np.zeros(Q.WIDTH + 1)).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos = rng.normal(2, 1, 4000)
    unl = np.concatenate([rng.normal(2, 1, 2800), rng.normal(-3, 1, 1200)])
    assert abs(Q.estimate_prior(pos, unl) - 0.7) < 0.08


def test_risk_gradient_by_differences():
    rng = np.random.default_rng(4)
    xp, xu = rng.normal(1, 1, (40, 6)), rng.normal(0, 1, (50, 6))
    for prior, scale in ((0.3, 1.0), (0.9, 3.0)):
        w = rng.normal(0, scale, 6)
        value, grad = Q.risk(w, xp, xu, prior)
        for k in range(6):
            step = np.zeros(6)
            step[k] = 1e-5
            slope = (Q.risk(w + step, xp, xu, prior)[0] - Q.risk(w - step, xp, xu, prior)[0]) / 2e-5
            assert abs(slope - grad[k]) < 1e-6


def test_quality_uses_unlabelled_documents_and_bounds_rows(spark):
    rng = random.Random(6)
    docs = [(i, words(rng, "abcdefg", 30) if i % 3 else words(rng, "XYZ", 30)) for i in range(300)]
    docs += docs[:150] + [(None, "no id")]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    assert Q.unlabelled_rows(docs_df, 40).select("doc_id").distinct().count() == 40
    assert Q._features_of(Q.unlabelled_rows(docs_df, 40), 40).shape == (40, Q.WIDTH)
    assert all(fold(r["doc_id"], Q.FOLDS) != Q.HELD_OUT for r in Q.unlabelled_rows(docs_df, 1000).collect())
    # labels mark good documents only: the rest is told apart by the unlabelled ones
    good = spark.createDataFrame([(i, 1) for i in range(300) if i % 3], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in Q.score(docs_df, Q.fit(docs_df, good)).collect() if r["doc_id"] is not None}
    right = sum((got[i] >= Q.CUT) == bool(i % 3) for i in got)
    assert right / len(got) > 0.95


def test_language_held_out(spark):
    rng = random.Random(3)
    kinds = {"xx": "abcdefg", "yy": "hijklmn", "zz": "éèêabhi"}
    docs = [(i, words(rng, kinds[lang], rng.randrange(5, 200)), lang)
            for i, lang in ((i, rng.choice(sorted(kinds))) for i in range(500))]
    docs += [(500, None, "xx"), (501, "123 ...", "yy"), (502, "", None), (503, "abc abc dfg " * 30_000, None)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in N.predict(docs_df, N.fit(docs_df)).collect()}
    assert len(got) == 504
    assert got[500] == got[501] == got[502] == ("und", 0.0) and got[503][0] == "xx"
    held = [(i, lang) for i, _, lang in docs[:500] if fold(i, N.FOLDS) == N.HELD_OUT]
    assert sum(got[i][0] == lang for i, lang in held) / len(held) > 0.97
    assert all(0 <= s <= 1 for _, s in got.values())


def test_tables_equal_the_convolution():
    net = N.Network(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (7, N.WINDOW)).astype(np.uint8)
    assert np.allclose(net.forward(x)[0], net.probabilities(x, net.tables()), atol=1e-5)


def test_gradients_by_differences():
    net = N.Network(["a", "b"])
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (5, 40)), rng.integers(0, 2, 5)

    def loss():
        return -np.log(net.forward(x)[0][np.arange(5), y]).mean()

    prob, kept = net.forward(x)
    grad = net.gradients(prob, y, kept)
    for k in net.p:
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-5
        up = loss()
        net.p[k][at] = old - 1e-5
        down = loss()
        net.p[k][at] = old
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7), k
