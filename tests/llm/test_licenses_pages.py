"""Licence rules against a plain reading of them; page texts and line alignment by brute force."""

import random

import numpy as np
import pytest

from simcat.llm import licenses as L, page_diff as P

MIT = "\n".join(t + "." for i, t in L.SENTENCES if i in ("mitGrant", "mitNotice", "mitAsIs", "mitLiability"))
BSD = {i: t for i, t in L.SENTENCES if i.startswith("bsd")}


def scan(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, licenses string")
    return {r["doc_id"]: r for r in L.scan(docs).collect()}


def test_licences(spark):
    texts = [None, "", " \n . ", "Plain prose. Nothing here!",
             "Text first.\nReleased under the MIT License.",
             "LICENSED under the  Apache License, Version 2.0", MIT,
             "\n".join([BSD["bsdIntro"], BSD["bsdSource"] + ".", BSD["bsdBinary"] + ".", BSD["bsdEndorse"]]),
             "\n".join([BSD["bsdIntro"], BSD["bsdSource"] + ".", BSD["bsdBinary"] + "."]),
             BSD["bsdBinary"] + ".\n" + BSD["bsdIntro"],
             "All rights reserved. All rights reserved.\nLicensed under CC BY-NC 4.0.",
             "Not licensed under the Apache License, Version 2.0 at all",
             "word. " * 50_000 + "Licensed under CC0 1.0."]
    got = scan(spark, texts)
    assert [got[i]["licenses"] for i in range(len(texts))] == [
        "", "", "", "", "MIT", "Apache-2.0", "MIT", "BSD-3-Clause", "BSD-2-Clause", "",
        "CC-BY-NC-4.0,all-rights-reserved", "", "CC0-1.0"]
    assert [got[i]["n_sentences"] for i in (0, 1, 2, 3, 4, 12)] == [0, 0, 0, 2, 2, 50_001]
    assert got[9]["n_unmatched"] == 2 and got[9]["sentence_ids"] == "bsdBinary,bsdIntro"
    assert got[10]["n_known"] == 3 and got[10]["n_unmatched"] == 0


def test_empty_table_and_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert L.scan(docs.limit(0)).count() == 0
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


@pytest.mark.parametrize("seed", range(8))
def test_alignment_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    for _ in range(60):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 25))], dtype=np.int64)
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 25))], dtype=np.int64)
        at = P.shared_lines(a, b)
        assert len(at) == lcs_length(a.tolist(), b.tolist())
        rest = iter(b.tolist())
        assert all(any(x == y for y in rest) for x in a[at].tolist())


PAGE = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li>Home</li></ul></nav><!-- ad --><div class=\"ad\">Buy</div><article><h1>A &amp; B</h1>"
        "<p><b>First\n  line<br>goes on<p>Second &eacute;</p><div class='comments'><p>me too</p></div>"
        "<aside>see also</aside><p>Third</p></article><footer>&copy; x</footer></body></html>")


def lines(page):
    return [t for s, t in P.lines_of(page) if s != P.DROP]


def test_page_structure():
    assert lines(PAGE) == ["A & B", "First line goes on", "Second é", "Third"]
    assert lines(None) == [] and lines("") == [] and lines("<<<") == ["<<<"]
    assert lines("plain &lt;text&gt;") == ["plain <text>"]
    assert lines("<div class=ad>open<article><p>kept</article>") == ["kept"]
    assert lines("<p>one</p><form><p>mail</p></form><p>two<p hidden>no</p>") == ["one", "two"]
    assert lines("<article><p>cut off &am") == ["cut off &am"]
    assert lines("<div class='with-sidebar'><p>text</p><div class='sidebar'>x</div></div>") == ["text"]
    assert lines("<form><div class='ad'>x</div><main><p>text</main></form>") == ["text"]
    assert lines("<p a='x>y'>z</p><p title=\"a") == ["z"]


def extract(spark, rows):
    pages = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows],
                                  "page_id long, url string, html string, open int")
    return sorted(((r["page_id"], r["text"], r["n_chars"]) for r in P.extract(pages.repartition(5)).collect()),
                  key=repr)


def test_shared_lines_of_near_urls_go(spark):
    page = lambda *own: "".join(f"<div>{x}</div>" for x in ("Site name", *own, "All about us"))
    rows = [(1, "http://a.org/x/1", page("one")), (2, "https://www.A.org/x/2?q=1", page("two", "more")),
            (3, "http://b.org/", page("alone")), (4, None, None), (5, "http://c.org/1", PAGE),
            (6, "http://c.org/2", PAGE), (7, "nonsense", "")]
    got = {i: t for i, t, _ in extract(spark, rows)}
    assert got[1] == "one" and got[2] == "two\nmore"
    assert got[3] == "Site name\nalone\nAll about us"
    assert got[4] == "" and got[7] == ""
    assert got[5] == got[6] == "A & B\nFirst line goes on\nSecond é\nThird"


def test_repeated_and_many_pages_of_one_host(spark):
    rows = [(i // 2, f"http://h.org/d/{i // 2}", f"<div>menu</div><div>text {i // 2}</div>")
            for i in range(400)]
    got = extract(spark, rows)
    assert len(got) == 400 and all(n == len(t) for _, t, n in got)
    # equal pages share all their lines, with their copy or with nothing else nearer
    assert all("menu" not in t for _, t, _ in got)
    assert P.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_in_hidden_parts_and_teasers():
    long = "real text of the page " * 20
    assert lines("<div class=comments><article class=comment><p>me too</p></article></div>"
                 "<article><p>text</p></article>") == ["text"]
    assert lines("<article><p>text</p></article><article class='ad'>buy</article>") == ["text"]
    assert lines("<div class=comments><article><p>me too</p></article></div><p>text</p>") == ["text"]
    assert lines(f"<div id=content><p>{long}</p></div><div><article>teaser</article></div>") == [
        long.strip(), "teaser"]
    for head in ("<svg-icon name=x>", "<object-x>", "<template-y a=b>", "<svg a='b'/>", "<svg />"):
        assert lines(f"<article>{head}<p>text</p></article>") == ["text"], head
    assert lines("<article><svg><path/><text>no</text></svg><p>text</p></article>") == ["text"]


def test_copies_are_no_partners_and_no_page_loses_all(spark):
    page = lambda *own: "".join(f"<div>{x}</div>" for x in ("menu", *own))
    rows = [(i, f"http://h.org/d/{i // 2}", page(f"text {i // 2}")) for i in range(60)]
    rows += [(100 + i, f"http://m.org/{i}", page("the same article")) for i in range(40)]
    rows += [(200, "http://n.org/a", page("one")), (201, "http://n.org/b", page("one", "more"))]
    got = {i: t for i, t, _ in extract(spark, rows)}
    assert all(got[i] == f"text {i // 2}" for i in range(60))
    assert all(got[100 + i] == "menu\nthe same article" for i in range(40))
    assert got[200] == "menu\none" and got[201] == "more"


def test_no_word_hides_an_article_and_short_articles_stay():
    for head in ("class='story share-enabled'", "id='article-reply-42'", "id=article-reply-42 class=story"):
        assert lines(f"<nav>menu</nav><article {head}><p>text</p></article><footer>x</footer>") == ["text"], head
    assert lines("<article><p>one</p><div class='social-history'><p>two</p></div><p>three</p></article>") == [
        "one", "two", "three"]
    assert lines("<article><p>one</p><div class='social-links-x'><a href=/a>a</a> <a href=/b>b</a></div>two"
                 "</article>") == ["one", "two"]
    for name in ("commentlist", "user-feedback", "post-comments", "commentList", "comment-thread", "share-buttons"):
        part = f"<ol class='{name}'><li>me too me too</li></ol>"
        assert lines(f"<article><p>text</p>{part}</article>") == ["text"], name
        assert lines(f"<article><p>text</p></article>{part}") == ["text"], name
    assert lines("<article><p>text</p></article><ol class=x><li>a longer remark</li></ol>") == ["text"]
    assert lines("<article class='post'><p>text</p></article><article class='reply-item-z'><p>no</p></article>") == [
        "text"]
    assert lines("<article class=comment><p>me too</p></article><div>text</div>") == ["text"]
    assert lines("<article><p>one<p class=ad>buy<p>two</article>") == ["one", "two"]
    assert lines("<article><p>one<p class=ad>buy</article><p>after</p>") == ["one"]


def test_many_comments_take_linear_time():
    import time
    comment = "<article class=comment><div><p>me too</p></div></article>"
    took = []
    for n in (5_000, 20_000):
        began = time.perf_counter()
        assert lines(f"<article><p>text</p></article><div class=comments>{comment * n}</div>") == ["text"]
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 1


def test_alignment_by_halves_is_as_long(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(3)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    for bits in (1 << 28, 1, 40):
        monkeypatch.setattr(P, "MAX_BITS", bits)
        for _ in range(60):
            a, b = (rng.integers(0, 6, rng.integers(0, 30)).astype(np.int64) for _ in range(2))
            got = P.shared_lines(a, b)
            assert len(set(got.tolist())) == len(got) == length(a.tolist(), b.tolist())
            rest = iter(b.tolist())
            assert all(any(x == y for y in rest) for x in a[got].tolist())


def test_pair_decides_hinted_parts_and_text_before_articles(spark):
    own = lambda i: (f"<article><p>story {i}</p><div class='social-history'><p>about the same club</p>"   # noqa: E731
                     f"<p>fact {i}</p></div></article>")
    rows = [(i, f"http://a.org/{i}", f"<p>Breaking: storm</p>{own(i)}<p>after {i}</p>") for i in range(3)]
    rows.append((9, "http://alone.org/", f"<p>lead</p>{own(9)}"))
    got = {i: t for i, t, _ in extract(spark, rows)}
    assert all(got[i] == f"story {i}\nfact {i}" for i in range(3))
    assert got[9] == "lead\nstory 9\nabout the same club\nfact 9"


def brute_pages(rows):
    """Texts and shared lines by plain Python: neighbours of a host among its distinct pages, one alignment each."""
    import difflib
    import re
    hosts = {}
    for i, url, page in rows:
        rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "")
        host = re.sub(r"^[^@]*@|^www\.|:[0-9]*$", "", re.match(r"[^/?#]*", rest).group(0).lower())
        path = re.sub(r"^/|/$", "", re.match(r"[^/?#]*([^?#]*)", rest).group(1)).split("/")
        hosts.setdefault(host, []).append((path, i, P.lines_of(page)))
    out = {}
    for pages in hosts.values():
        pages.sort(key=lambda p: p[:2])
        firsts = {}
        for path, i, found in pages:
            seen = tuple((s, t) for s, t in found if s != P.DROP)
            if seen:
                firsts.setdefault(seen, (path, i, found))
        order = sorted(firsts.values(), key=lambda p: p[:2])
        at = {i: n for n, (_, i, _) in enumerate(order)}
        for path, i, found in pages:
            seen = tuple((s, t) for s, t in found if s != P.DROP)
            text, shared = [t for _, t in seen], 0
            if seen:
                path, first, found = firsts[seen]
                n = at[first]
                near = [(sum(1 for k in range(min(len(path), len(q))) if path[:k + 1] == q[:k + 1]), m)
                        for m, (q, _, _) in enumerate(order) if m in (n - 1, n + 1)]
                if near:
                    a, b = [t for _, t in found], [t for _, t in order[max(near)[1]][2]]
                    blocks = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
                    lost = {k for x in blocks for k in range(x.a, x.a + x.size)}
                    shared = len(lost)
                    left = [t for k, (s, t) in enumerate(found) if s == P.KEEP or s == P.OPEN and k not in lost]
                    text = left or text
            out[i] = ("\n".join(text), shared)
    return out


def test_given_pages_by_brute_force_and_without_pairs(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    got = {r["page_id"]: r for r in P.extract(pages).collect()}
    want = brute_pages(rows)
    assert len(got) == len(rows) and all(got[i]["text"] == t for i, (t, _) in want.items())
    # the alignment is the longest, the brute version's may be shorter
    assert all(got[i]["n_shared"] >= n for i, (_, n) in want.items())
    plain = {r["page_id"]: r for r in P.extract(pages, paired=False).collect()}
    # without pairs the shared lines are not found; they are menus and adverts here, which the markup settles too
    assert {i for i in got if got[i]["n_shared"] != plain[i]["n_shared"]} == {i for i, (_, n) in want.items() if n}
    assert any(n for _, n in want.values())


def test_pairs_do_not_depend_on_partitions(spark):
    import random
    draw = random.Random(5)
    rows = [(i, f"http://{draw.choice('ab')}.org/{draw.choice('xy')}/{draw.randrange(30)}",
             "".join(f"<div>{draw.choice(('menu', 'login', 'news', f'own {i}'))}</div>" for _ in range(4)))
            for i in range(70)]
    want = brute_pages(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "40", "90"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r["page_id"]: r for r in P.extract(pages).collect()}
            assert {i: bool(r["n_shared"]) for i, r in got.items()} == {i: bool(k) for i, (_, k) in want.items()}, n
            if n == "1":
                first = got
            assert got == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_wrapped_notices(spark):
    import textwrap
    said = dict(reversed([(i, t) for i, t in L.SENTENCES]))
    wrap = lambda *ids, end=".": [textwrap.fill(said[i] + end, 60) for i in ids]
    mit = "\n\n".join(wrap("mitGrant", end="") + wrap("mitNotice", "mitAsIs") + wrap("mitLiability"))
    bsd = "\n\n".join(["Copyright (c) 2020, X\nAll rights reserved.", *wrap("bsdIntro", end=""),
                       *[f"{n}. {t}" for n, t in enumerate(wrap("bsdSource", "bsdBinary", "bsdEndorse"), 1)]])
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except\n"
              "in compliance with the License.\nYou may obtain a copy of the License at\n\n"
              "    http://www.apache.org/licenses/LICENSE-2.0\n\n" + wrap("apacheAsIs")[0])
    gpl2 = textwrap.fill("; ".join(said[i] for i in ("gplFree", "gplTerms", "gplTerms2p")) + ". " + "; ".join(
        said[i] for i in ("gplHope", "gplImplied")) + ". " + said["gplSee"] + ".", 60)
    gpl3 = "\n\n".join(wrap("gplTerms3pOne"))
    mpl = textwrap.fill(said["mplRef"] + ". " + said["mplCopy"] + ".", 60)
    isc = "Copyright 2020 X\n" + wrap("iscGrant")[0]
    texts = [mit, bsd, apache, gpl2, gpl3, mpl, isc]
    want = ["MIT", "BSD-3-Clause,all-rights-reserved", "Apache-2.0", "GPL-2.0-or-later", "GPL-3.0-or-later",
            "MPL-2.0", "ISC"]
    comments = [t.replace("\n", "\r\n * ") for t in texts] + ["# " + t.replace("\n", "\n# ") for t in texts]
    # a blank line ends a sentence
    got = scan(spark, texts + comments + ["Released under\n\nthe MIT License", "Released under\nthe MIT License"])
    assert [got[i]["licenses"] for i in range(23)] == want * 3 + ["", "MIT"]
    assert got[21]["n_sentences"] == 2 and got[22]["n_sentences"] == 1
    assert all(got[i]["n_unmatched"] == 0 for i in range(21))
