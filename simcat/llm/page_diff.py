"""Main text of web pages by nearest-URL differencing.

Every page is cut into text lines (blocks).  Pages are ordered by host and URL path, and each is
paired with the neighbour of its host whose path shares the most leading segments; pages of a host
with the same visible lines count once there, so a copy is never the partner.  All lines of a pair, whatever
their markup, are aligned by their longest common subsequence; ``n_shared`` is how many a page shares, and shared
lines that no markup protects are template and go.  The markup settles two kinds of lines: lines in navigation,
headers, footers, sidebars, forms, notices, adverts, comments and the like always go, and lines of
an ``article`` or ``main`` element always stay, because a copied or quoted passage that two
articles share is content.  On pages with such an element the rest of the page goes, but for paragraphs before
the first article (a story whose page ends in teasers): about those the pair decides.
No page loses all its lines to its pair.

Words in class and id names hide a part where they make up a whole name (``share-buttons``, ``commentlist``).  Inside
an article a name that only holds such a word (``social-history``) hides nothing: the pair decides, and lines that are mostly
links go.  A word never hides the only article of a page; an article named by one goes where a plain article
stands before it, or where its whole name says so and the page has other text.  Articles in a hidden part are
hidden; only the first ``article`` or ``main`` of a page ends a part that was never closed.

Pages of one host are not gathered in one task: the order is a distributed sort, neighbours meet
where it puts them (those at the ends of a partition by their position), and only line hashes travel.  A page is parsed once.

Defined results: null or empty html gives an empty text; a page alone on its host loses nothing to
a pair; a broken or cut page is read as far as it goes; equal URLs are ordered by page_id;
repeated rows are pages of their own; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import hot_join, materialise, small_batches, table

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*/>"
    r"|<(script|style|noscript|template|svg|math|iframe|object|select|textarea|title)(?=[\s/>])[^>]*>"
    r".*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                       re.I)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEMPLATE = frozenset("nav footer aside form menu button dialog head".split())
MAIN = frozenset(("article", "main"))
# Words of class and id names that mark a part of the page as no main text.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget footer "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login comment comments reply replies respond disqus share sharing social related "
    "recommended recommendations masthead toolbar skip feedback".split())
# Words that say nothing of their own beside such a word.
NEUTRAL = tuple(
    "area bar block box buttons button container content form group icons inner item items link links list "
    "module panel post posts section slot stories thread top bottom user wrap wrapper".split())
STATES = ("has-", "with-", "no-", "without-", "has_", "with_", "no_")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
PARAGRAPHS = frozenset(("p", "blockquote", "pre"))

DROP, OPEN, KEEP = 0, 1, 2
MAX_BITS = 1 << 28               # bits of one alignment held at a time
PLAIN, HINT, SURE = 0, 1, 2      # what a part's names say: nothing, a listed word among others, nothing else


def _listed(word: str) -> bool:
    return word in NAMES or any(word.endswith(w) and word[:-len(w)] in NAMES for w in NEUTRAL)


def _named(value: str) -> int:
    """PLAIN, HINT or SURE for the names in a class or id."""
    best = PLAIN
    for name in value.split():
        if name.lower().startswith(STATES):
            continue                     # what is beside the text, not the text
        words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()) if w]
        if any(map(_listed, words)):
            if all(w.isdigit() or w in NEUTRAL or _listed(w) for w in words):
                return SURE
            best = HINT
    return best


def _template(name: str, attributes: str, in_main: bool) -> tuple[bool, int]:
    """Whether the element hides what it holds by what it is, and what its names say."""
    if name in TEMPLATE or (name == "header" and not in_main):
        return True, SURE
    named = PLAIN
    if name in ("body", "html") or not attributes:
        return False, named
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if key in ("class", "id"):
            named = max(named, _named(value) if name != "main" else PLAIN)
        elif key == "role":
            if value.lower() in ROLES:
                return True, SURE
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True, SURE
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True, SURE
    return False, named


def _settle(lines: list, articles: list[tuple[str, int]]) -> list[tuple[int, str]]:
    """States of parsed lines, from the articles that hold the page's text."""
    filled = {a for hidden, a, *_ in lines if a >= 0 and not hidden}
    plain = [a for a in sorted(filled) if articles[a][1] == PLAIN]
    outside = any(a < 0 and not hidden for hidden, a, *_ in lines)
    hinted = any(articles[a][1] == HINT for a in filled)

    def stays(a):
        named = articles[a][1]
        if named == PLAIN:
            return True
        if named == HINT:
            return not plain or a < plain[0]
        return not plain and not hinted and not outside

    kept = {a for a in filled if stays(a)}
    only = any(articles[a][0] == "main" for a in kept)
    out, seen = [], False
    for hidden, a, hint, paragraph, links, text in lines:
        if hidden or (a >= 0 and a not in kept):
            state = DROP
        elif a >= 0:
            seen = True
            state = KEEP if not hint else DROP if 2 * links >= len(text) else OPEN
        elif not kept:
            state = OPEN
        else:
            state = OPEN if paragraph and not seen and not only and 2 * links < len(text) else DROP
        out.append((state, text))
    return out


def lines_of(page: str | None) -> list[tuple[int, str]]:
    """(DROP, OPEN or KEEP, text) of the blocks of a page, in page order."""
    if not page:
        return []
    lines: list = []             # hidden, article, hinted, paragraph, characters in links, text
    held: list[str] = []
    linked, in_link = 0, False
    skip: str | None = None      # element that hides what it holds, and how deep it is nested
    depth = 0
    hint: str | None = None      # element in an article whose names hold a listed word
    hint_depth = 0
    articles: list[tuple[str, int]] = []
    main: list[tuple[str, int]] = []
    paragraph = False
    balance: Counter | None = None

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            held.clear()
            if text:
                lines.append((skip is not None, main[0][1] if main else -1, hint is not None, paragraph,
                              linked, text))
        linked = 0

    def never_closed(name):
        """Whether the page opens more elements of this name than it closes (counted once per page)."""
        nonlocal balance
        if balance is None:
            balance = Counter()
            for t in MARKUP.finditer(page):
                if t.group(3):
                    balance[t.group(3).lower()] += -1 if t.group(2) else 1
        return balance[name] > 0

    def take(text):
        nonlocal linked
        held.append(text)
        if in_link:
            linked += len(text.strip())

    at = 0
    for m in MARKUP.finditer(page):
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        name = m.group(3)
        if name is None:
            continue
        name, closing = name.lower(), bool(m.group(2))
        if name == "br":
            held.append(" ")
            continue
        if name == "a":
            in_link = not closing
        if name not in BLOCKS and name not in TEMPLATE and name not in MAIN and skip is None and hint is None \
                and not (m.group(4) and not closing and "=" in m.group(4)):
            continue
        if skip == "p" and name in BLOCKS and not (closing and name == "p"):
            flush()                       # a paragraph ends where a block begins or its own ends
            skip, depth = None, 0
        hides, named = False, PLAIN
        if skip is not None:
            if name in MAIN and not closing and not articles and (skip not in TEMPLATE or skip == "form") \
                    and _template(name, m.group(4), False) == (False, PLAIN) \
                    and (skip == "form" or never_closed(skip)):
                flush()                       # an element left open can't swallow the article
                skip, depth = None, 0
            elif name == skip:
                if closing and depth == 1:
                    flush()
                    skip, depth = None, 0
                    continue
                depth += -1 if closing else 1
        elif not closing and name not in VOID and not m.group(4).rstrip().endswith("/"):
            hides, named = _template(name, m.group(4), bool(main))
            if name not in MAIN or main:
                hides = hides or named == SURE or (named == HINT and not main)
        if hides:
            flush()
            skip, depth = name, 1
            continue
        if name in BLOCKS or name in MAIN:
            flush()
            paragraph = not closing and (name in PARAGRAPHS or (paragraph and name not in MAIN and name != "div"))
        if skip is not None:
            continue
        if hint is not None and name == hint:
            hint_depth += -1 if closing else 1
            if hint_depth == 0:
                flush()
                hint = None
        elif hint is None and named == HINT and main:
            flush()
            hint, hint_depth = name, 1
        if name in MAIN:
            if not closing:
                if not main:
                    articles.append((name, named))
                main.append((name, len(articles) - 1))
            else:
                for i in range(len(main) - 1, -1, -1):
                    if main[i][0] == name:
                        del main[i:]
                        break
                if not main:
                    hint = None
    if at < len(page):
        rest = page[at:]
        cut = rest.rfind("<")
        take(rest if cut < 0 or not re.match(r"<[a-zA-Z/!]", rest[cut:]) else rest[:cut])
    flush()
    return _settle(lines, articles)


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of ``a`` in a longest common subsequence of ``a`` and ``b`` (line hashes)."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    same = a[len(a) - n:][::-1] == b[len(b) - n:][::-1]
    tail = min(n - head, n if same.all() else int(same.argmin()))
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    # lines that only one page has can't be part of it
    at, y = np.flatnonzero(np.isin(x, y)), y[np.isin(y, x)]
    picked = at[_aligned(x[at], y)] + head if len(at) else at
    return np.sort(np.concatenate([np.arange(head), np.arange(len(a) - tail, len(a)), picked])).astype(np.int64)


def _rows(x: np.ndarray, y: np.ndarray):
    """Bit rows of the alignment of ``x``, line by line, with ``y``: zero bits mark the steps of its length."""
    where: dict[int, int] = {}
    for j, h in enumerate(y.tolist()):
        where[h] = where.get(h, 0) | (1 << j)
    full = (1 << len(y)) - 1
    v = full
    for h in x.tolist():
        u = v & where.get(h, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the alignment of ``x`` with each prefix of ``y``."""
    v = (1 << len(y)) - 1
    for v in _rows(x, y):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[:len(y)].astype(np.int64))])


def _aligned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Positions of ``x`` in a longest common subsequence; halves ``x`` where all bit rows would not fit."""
    if not len(x) or not len(y):
        return np.zeros(0, np.int64)
    if len(x) > 1 and len(x) * len(y) > MAX_BITS:
        mid = len(x) // 2
        j = int((_lengths(x[:mid], y) + _lengths(x[mid:][::-1], y[::-1])[::-1]).argmax())
        return np.concatenate([_aligned(x[:mid], y[:j]), _aligned(x[mid:], y[j:]) + mid])
    full = (1 << len(y)) - 1
    rows = list(_rows(x, y))
    j, picked = len(y), []
    for i in range(len(x) - 1, -1, -1):
        before = rows[i - 1] if i else full
        low = (1 << j) - 1
        now_n = j - (rows[i] & low).bit_count()
        if now_n == j - (before & low).bit_count():
            continue                     # the prefix without line i is as long
        # line i is matched with the last place where the length grows
        while j and now_n == (j - 1) - (rows[i] & ((1 << (j - 1)) - 1)).bit_count():
            j -= 1
        picked.append(i)
        j -= 1
    return np.array(picked[::-1], dtype=np.int64)


def _hash(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def _outline(batches):
    """One row per page: its text, the states of all its lines and their hashes, and ``lines``, a digest of the
    visible lines and which of them are open (null where a page has none)."""
    schema = pa.schema([("rid", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                        ("states", pa.binary()), ("hashes", pa.binary()), ("lines", pa.binary())])
    for batch in batches:
        texts, states, hashes, digests = [], [], [], []
        for page in batch.column(3):
            found = lines_of(page.as_py())
            texts.append("\n".join(t for s, t in found if s != DROP))
            states.append(bytes(s for s, _ in found))
            own = [_hash(t) for _, t in found]
            hashes.append(b"".join(own))
            seen = [h + bytes([s]) for h, (s, _) in zip(own, found) if s != DROP]
            digests.append(blake2b(b"".join(seen), digest_size=32).digest() if seen else None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(texts, pa.string()), pa.array(states, pa.binary()),
             pa.array(hashes, pa.binary()), pa.array(digests, pa.binary())], schema=schema)


def _shared(states: bytes, own: bytes, other: bytes) -> tuple[int, list[int]]:
    """How many lines a page shares with its pair, and the numbers of the visible ones it loses."""
    state = np.frombuffer(states, dtype=np.uint8)
    shared = shared_lines(np.frombuffer(own, dtype=np.int64), np.frombuffer(other, dtype=np.int64))
    lost = (np.cumsum(state != DROP) - 1)[shared[state[shared] == OPEN]]
    # a page that the other one holds whole is no template
    return len(shared), lost.tolist() if len(lost) < (state != DROP).sum() else []


def _common(p, q) -> int:
    """Leading segments that two paths share."""
    return next((i for i, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q)))


def _pair(row: dict, before: dict | None, after: dict | None) -> tuple[int, list[int]]:
    """The result of a page with the neighbour of its host that has the nearest path (the later one if both do)."""
    near = [(_common(row["path"], o["path"]), i, o) for i, o in enumerate((before, after))
            if o is not None and o["host"] == row["host"]]
    if not near:
        return 0, []
    return _shared(row["states"], row["hashes"], max(near, key=lambda t: t[:2])[2]["hashes"])


PAIRED = "host string, lines binary, path array<string>, states binary, hashes binary, part int, at long, " \
         "n_shared long, gone array<int>"
PAIRED_ARROW = pa.schema([("host", pa.string()), ("lines", pa.binary()), ("path", pa.list_(pa.string())),
                  ("states", pa.binary()), ("hashes", pa.binary()), ("part", pa.int32()), ("at", pa.int64()),
                  ("n_shared", pa.int64()), ("gone", pa.list_(pa.int32()))])


def _inside(batches):
    """Pairs of a sorted partition.  Its first and last row have a neighbour elsewhere: they get no result yet
    (``n_shared`` null) and keep their lines, as do the rows beside them."""
    from pyspark import TaskContext
    part, n, out = TaskContext.get().partitionId(), 0, []
    held: list[dict] = []             # the last three rows

    def emit(row, result, keep):
        out.append({"host": row["host"], "lines": row["lines"], "part": part, "at": row["at"],
                    **{c: row[c] if keep else None for c in ("path", "states", "hashes")},
                    "n_shared": result and result[0], "gone": result and result[1]})

    for batch in batches:
        for row in batch.to_pylist():
            row["at"] = n
            n += 1
            held.append(row)
            if len(held) == 4:
                held.pop(0)
            if n == 1:
                continue
            if n == 2:
                emit(held[0], None, True)
            else:
                # two rows on, a row is known not to be the last but one
                if n > 3:
                    emit(held[-3], held[-3]["result"], held[-3]["at"] <= 1)
                held[-2]["result"] = _pair(held[-2], held[-3], held[-1])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=PAIRED_ARROW)
            out.clear()
    if n > 2:
        emit(held[-2], held[-2]["result"], True)
    if n:
        emit(held[-1], None, True)
        yield pa.RecordBatch.from_pylist(out, schema=PAIRED_ARROW)


def _across(batches):
    """Results of rows at the edge of a partition, from the rows before and after."""
    schema = pa.schema([("host", pa.string()), ("lines", pa.binary()), ("n_shared", pa.int64()),
                        ("gone", pa.list_(pa.int32()))])
    for batch in batches:
        rows = batch.to_pylist()
        found = [_pair(r["own"], r["before"], r["after"]) for r in rows]
        yield pa.RecordBatch.from_pylist(
            [{"host": r["own"]["host"], "lines": r["own"]["lines"], "n_shared": n, "gone": g}
             for r, (n, g) in zip(rows, found)], schema=schema)


def host_and_path(url):
    """Columns host (lower case, no user, port or leading www.) and path segments of ``url``."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
                            "^[^@]*@|^www\\.|:[0-9]*$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), "^/|/$", "")
    return host, F.split(path, "/")


def shared_with_pair(outline: DataFrame) -> DataFrame:
    """``rid``, ``n_shared`` and ``gone``, the numbers of the visible lines a page loses, for pages with a pair.

    ``outline`` has rid, page_id, url, states, hashes, lines.
    """
    spark = outline.sparkSession
    host, path = host_and_path(F.col("url"))
    told = (outline.filter(F.col("lines").isNotNull())
            .select("rid", "page_id", host.alias("host"), path.alias("path"), "states", "hashes", "lines"))
    # pages of a host with the same visible lines count once, as the first of them
    place = F.struct("path", "page_id", "rid")
    alike = (told.groupBy("host", "lines")
             .agg(F.min(place).alias("first"), F.min_by(F.struct("states", "hashes"), place).alias("own"))
             .select("host", "lines", "first.*", "own.*"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "page_id", "rid"]
    ordered = (materialise(alike, "alike").repartitionByRange(n, *order).sortWithinPartitions(*order)
               .select("host", "lines", "path", "states", "hashes"))
    # neighbours meet where the order puts them; only the ends of a partition have theirs elsewhere
    inside = materialise(ordered.mapInArrow(_inside, PAIRED), "pairs")
    # one row per partition: where its numbering starts
    sizes = {r["part"]: r["n"] for r in inside.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offset = F.broadcast(spark.createDataFrame(starts or [(0, 0)], "part int, before long"))
    # at most four rows of a partition
    edges = (inside.filter(F.col("hashes").isNotNull()).join(offset, "part")
             .select((F.col("at") + F.col("before")).alias("place"), F.col("n_shared").isNull().alias("missing"),
                     F.struct("host", "lines", "path", "states", "hashes").alias("row")))
    at = lambda by, name: edges.select((F.col("place") + by).alias("place"), F.col("row").alias(name))
    across = (edges.filter("missing").select("place", F.col("row").alias("own"))
              .join(at(1, "before"), "place", "left").join(at(-1, "after"), "place", "left")
              .select("own", "before", "after")
              .mapInArrow(_across, "host string, lines binary, n_shared long, gone array<int>"))
    key = ["host", "lines"]
    shared = materialise(inside.select(*key, "n_shared", "gone").unionByName(across).filter("n_shared > 0"),
                         "shared-lines")
    rows = told.select("rid", *key)
    sizes_of = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"))
    groups = materialise(shared.join(sizes_of, key), "shared-groups")
    return hot_join(rows, groups, key, told.count()).select("rid", "n_shared", "gone")


def extract(pages: DataFrame, paired: bool = True) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, ``n_shared`` of every row of ``pages``.

    ``n_shared`` counts the page's lines that its pair shares, template lines too (for copies: of the first of
    them); 0 without a pair.  ``paired=False`` leaves the differencing out.
    """
    spark = pages.sparkSession
    small_batches(spark)
    outline = materialise(
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
        .select(F.monotonically_increasing_id().alias("rid"), "page_id", "url", "html")
        .mapInArrow(_outline, "rid long, page_id long, url string, text string, states binary, hashes binary, "
                              "lines binary"),
        "outline")
    if not paired:
        return outline.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                              F.lit(0).cast("long").alias("n_shared"))
    found = materialise(shared_with_pair(outline), "template-lines")
    joined = outline.select("rid", "page_id", "url", "text").join(found, "rid", "left")
    # lines are joined by \n and hold none, so the text can be cut into them again
    left = F.array_join(F.filter(F.split("text", "\n"), lambda t, i: ~F.array_contains("gone", i)), "\n")
    out = F.when(F.coalesce(F.size("gone"), F.lit(0)) <= 0, F.col("text")).otherwise(left)
    return joined.select("page_id", "url", out.alias("text"),
                         F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
