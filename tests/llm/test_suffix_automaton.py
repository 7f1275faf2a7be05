"""Decontamination against brute force."""

import hashlib
import random

from simcat.llm import suffix_automaton as S


def expected(rows, items, window):
    wins = {}
    for ident, t in items:
        w = S.words_of(t)
        n = min(len(w), window)
        if n:
            for i in range(len(w) - n + 1):
                wins.setdefault(tuple(w[i:i + n]), set()).add(str(ident))
    out = []
    for ident, t in rows:
        w = S.words_of(t)
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((ident, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out)


def run(spark, rows, items, window=S.WINDOW):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r)[:6] for r in S.match(docs, bench, window).collect())


def test_edge_cases(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "!!!"),
             (10, "short item"), (11, "Solo"), (12, "short item")]
    rows = [(1, None), (2, ""), (3, "... !"), (4, "A SHORT, item solo"), (5, "clean words only"),
            (6, "x One Two three-four five six seven eight nine TEN y"),
            (7, "word " * 30_000 + "short item")]
    assert run(spark, rows, items) == expected(rows, items, 10)


def test_no_items_and_no_rows(spark):
    assert run(spark, [(1, "a b")], []) == expected([(1, "a b")], [], 10)
    assert run(spark, [], [(1, "a b")]) == []


def test_random_texts(spark):
    rng = random.Random(1)
    draw = lambda n: " ".join(rng.choice("abcde") for _ in range(n))
    items = [(i, draw(rng.randrange(0, 14))) for i in range(30)]
    rows = [(i, draw(rng.randrange(0, 60))) for i in range(80)]
    for window in (3, 6):
        assert run(spark, rows, items, window) == expected(rows, items, window)


def test_blocks_find_the_same():
    rng = random.Random(2)
    text = " ".join(str(rng.randrange(40)) for _ in range(300))
    parts = list(S.blocks_of([(1, text), (2, "a b c"), (3, text[:200])], 5, block_words=50))
    assert len(parts) > 3
    whole = S.Automaton(5).build([("1", S.words_of(text)), ("2", ["a", "b", "c"]),
                                  ("3", S.words_of(text[:200]))])
    for start in range(0, 290, 17):
        words = S.words_of(text)[start:start + 9] + ["no"]
        spans, found = [], set()
        for p in parts:
            s, f = S.Automaton(5).build(p).spans(words)
            spans, found = spans + s, found | f
        assert S.union(spans) == whole.spans(words)[0] and found == whole.spans(words)[1]


def test_clean_documents(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Before all. {item}! And after that comes more", 5), (2, item, 3),
                                  (3, "clean", 9), (4, None, None)],
                                 "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in S.clean_documents(docs, bench).collect()}
    text = "Before all. ! And after that comes more"
    assert got == {1: (text, len(text)), 3: ("clean", 9), 4: (None, None)}


def test_groups_of_blocks_find_the_same(spark):
    rng = random.Random(5)
    draw = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = [(i, draw(rng.randrange(0, 14))) for i in range(40)] + [(3, "solo"), (3, "solo")]
    rows = [(i, draw(rng.randrange(0, 60))) for i in range(60)] + [(9, None), (9, "solo"), (None, "solo")]
    hot = rows[0][1] + " solo"
    rows += [(100 + i, hot) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x", [1]) for i, t in rows],
                                 "doc_id long, text string, starts string, items array<int>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert S.written_blocks(bench, 4, "item_id", 30).count() > 2 * S.GROUP_BLOCKS
    got = S.match(docs, bench, 4, block_words=30)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = sorted((tuple(r)[:6] for r in got.collect()), key=key)
    want = expected([(-1 if i is None else i, t) for i, t in rows], items, 4)
    assert got == sorted(((None if r[0] == -1 else r[0], *r[1:]) for r in want), key=key)
    whole, cut = (S.clean_documents(docs, bench, 4, 0.9, block_words=n) for n in (S.BLOCK_WORDS, 30))
    assert cut.columns == docs.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
