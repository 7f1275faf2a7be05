"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items are cut into blocks of about ``BLOCK_WORDS`` words; each block's automaton is built in a
task and written to the shared folder.  Documents stream through it word by word while the longest
match ending at each word is tracked.  A match of at least ``window`` words marks those words as
hit.  Items of fewer words count as one window of their own length.  Before streaming, words that
can't be part of a window are skipped: each pair of adjacent words of a window must be a pair of
adjacent words of some item.

The automata grow with the benchmark, not with the corpus, and no more than ``GROUP_BLOCKS`` of them are
on the driver or in a worker at a time: the documents stream once per such group.  Each group but
the last writes the spans of the texts it hits, by the text's hash; the last one's pass unites them with its own.

Defined results: null and empty texts have no words and are clean; null or wordless items are
ignored; repeated items count once; a very long item is cut between blocks with ``window - 1``
words of overlap; extra columns are untouched.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import LOWER_TABLE, materialise, shared_path, small_batches, table

WINDOW = 10
BLOCK_WORDS = 200_000
GROUP_BLOCKS = 2         # automata that a worker holds at a time
CHARS = 6                # of a word with its space, about; sets the number of build tasks only
SALTS = 16               # copies of a hit text's row, so that rows of one text don't meet in one task
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(LOWER_TABLE)) if text else []


class Automaton:
    """Generalised suffix automaton of integer sequences with the windows' items per state."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.vocab: dict[str, int] = {}
        self.pairs: set[int] = set()
        self.singles: set[int] = set()       # words that are a whole item
        self.items: dict[int, set] = {}      # state -> items with a window of it
        self.short: dict[int, dict[int, set]] = {}   # state -> {length: items of just that length}

    @classmethod
    def of(cls, state: dict) -> "Automaton":
        """The automaton with these attributes (``vars`` of a built one)."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def build(self, items: list[tuple[str, list[str]]]) -> "Automaton":
        coded = []
        for ident, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            coded.append((ident, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        base = len(self.vocab) + 1
        for _, ids in coded:
            self.pairs.update(a * base + b for a, b in zip(ids, ids[1:]))
        # which items a window belongs to: stream every item through the finished automaton
        for ident, ids in coded:
            n = min(len(ids), self.window)
            state, k = 0, 0
            for c in ids:
                state, k = self.step(state, k, c)
                if k >= n:
                    at = self.state_of(state, n)
                    if n == self.window:
                        self.items.setdefault(at, set()).add(ident)
                    else:
                        self.short.setdefault(at, {}).setdefault(n, set()).add(ident)
                        if n == 1:
                            self.singles.update(ids)
        # nearest state on the suffix path (itself included) that has short items
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.short_up = [-1] * len(self.length)
        for v in order:
            self.short_up[v] = v if v in self.short else self.short_up[self.link[v]]
        self.shortest = min([self.window, *(n for d in self.short.values() for n in d)])
        self.pair_array = np.array(sorted(self.pairs), dtype=np.int64)
        self.base = base
        del self.pairs
        return self

    def step(self, state: int, k: int, c: int) -> tuple[int, int]:
        nxt = self.next
        while state and c not in nxt[state]:
            state = self.link[state]
            k = self.length[state]
        to = nxt[state].get(c)
        return (to, k + 1) if to is not None else (0, 0)

    def state_of(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match that stands in ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def runs(self, ids: np.ndarray):
        """Stretches of words that can hold a window."""
        if len(ids) == 0:
            return
        ok = ids >= 0
        if self.shortest > 1:
            code = ids[:-1].astype(np.int64) * self.base + ids[1:]
            both = ok[:-1] & ok[1:]
            at = np.searchsorted(self.pair_array, code)
            at[at == len(self.pair_array)] = 0
            joined = both & (self.pair_array[at] == code) if len(self.pair_array) else both & False
            edge = np.flatnonzero(np.diff(np.concatenate(([0], joined.view(np.int8), [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a + 1 >= self.shortest:
                    yield a, b + 1
        else:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
            yield from zip(edge[::2].tolist(), edge[1::2].tolist())

    def spans(self, words: list[str]) -> tuple[list[tuple[int, int]], set]:
        """Hit spans [from, to) of ``words``, ascending and merged, and the items found."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        spans: list[list[int]] = []
        found: set = set()
        for a, b in self.runs(ids):
            state, k = 0, 0
            for i in range(a, b):
                state, k = self.step(state, k, int(ids[i]))
                reach = 0
                if k >= self.window:
                    reach = self.window
                    found |= self.items[self.state_of(state, reach)]
                s = self.short_up[state]
                while s > 0:
                    limit = k if s == state else self.length[s]
                    for n, idents in self.short[s].items():
                        if n <= limit:
                            reach = max(reach, n)
                            found |= idents
                    s = self.short_up[self.link[s]]
                if reach:
                    lo, hi = i + 1 - reach, i + 1
                    while spans and spans[-1][1] >= lo:
                        lo = min(lo, spans.pop()[0])
                    spans.append([lo, hi])
        return [(x, y) for x, y in spans], found


def blocks_of(items, window: int, block_words: int = BLOCK_WORDS):
    """Blocks of (item, words) with at most about ``block_words`` words each."""
    block, n = [], 0
    for ident, text in items:
        words = words_of(text)
        while words:
            part = words[:block_words]
            block.append((str(ident), part))
            n += len(part)
            words = words[block_words - window + 1:] if len(words) > block_words else []
            if n >= block_words:
                yield block
                block, n = [], 0
    if block:
        yield block


def written_blocks(benchmark: DataFrame, window: int, item_id: str, block_words: int) -> DataFrame:
    """``block``, ``automaton`` (pickled attributes) of all items, in the shared folder."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
                             "text").filter(F.length("text") > 0).distinct()
    items = materialise(items, "items")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    schema = pa.schema([("automaton", pa.binary())])

    def build(batches):
        rows = ((i, t.as_py()) for batch in batches
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1)))
        for block in blocks_of(rows, window, block_words):
            state = pickle.dumps(vars(Automaton(window).build(block)), protocol=5)
            yield pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], schema=schema)

    built = items.repartition(1 + chars // (CHARS * block_words)).mapInArrow(build, "automaton binary")
    return materialise(built.withColumn("block", F.monotonically_increasing_id()), "automata")


class Search:
    """The automata of a benchmark, and what all groups of them but the last have found in ``docs``."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, window: int, text: str, item_id: str,
                 block_words: int):
        self.spark, self.text = docs.sparkSession, text
        small_batches(self.spark)
        blocks = written_blocks(benchmark, window, item_id, block_words)
        # one number per block
        ids = [r["block"] for r in blocks.select("block").orderBy("block").collect()]
        groups = [ids[a:a + GROUP_BLOCKS] for a in range(0, len(ids), GROUP_BLOCKS)] or [[]]
        path = shared_path(self.spark, "spans")
        for group in groups[:-1]:
            automata = self._broadcast(blocks, group)
            self._hits(docs, automata).write.mode("append").parquet(path)
            automata.unpersist()
        self.last = self._broadcast(blocks, groups[-1])
        self.earlier = self.spark.read.parquet(path) if len(groups) > 1 else None

    def _broadcast(self, blocks: DataFrame, group: list[int]):
        rows = blocks.filter(F.col("block").isin(group)).select("automaton").collect()
        return self.spark.sparkContext.broadcast([pickle.loads(r[0]) for r in rows])

    def _key(self):
        return F.unhex(F.sha2(F.col(self.text).cast("binary"), 256))

    def _hits(self, docs: DataFrame, automata) -> DataFrame:
        schema = pa.schema([("key", pa.binary()), ("starts", pa.list_(pa.int64())),
                            ("stops", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])

        def run(batches):
            found_by = [Automaton.of(a) for a in automata.value]
            for batch in batches:
                out = []
                for key, t in zip(batch.column(0), batch.column(1)):
                    spans, items = look(words_of(t.as_py()), found_by)
                    if spans:
                        out.append({"key": key.as_py(), "starts": [a for a, _ in spans],
                                    "stops": [b for _, b in spans], "items": sorted(items)})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

        return docs.select(self._key().alias("key"), F.col(self.text)).mapInArrow(
            run, "key binary, starts array<long>, stops array<long>, items array<string>").dropDuplicates(["key"])

    def rows(self, docs: DataFrame) -> DataFrame:
        """``docs`` with three last columns: starts, stops and items of the groups before the last."""
        names = [next(n for n in (c + "_" * i for i in range(len(docs.columns) + 1)) if n not in docs.columns)
                 for c in ("starts", "stops", "items")]
        types = ["array<long>", "array<long>", "array<string>"]
        if self.earlier is None:
            return docs.select("*", *[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
        by_text = self.earlier.groupBy(F.col("key").alias("k")).agg(
            *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops", "items")])
        copies = by_text.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = docs.select(F.struct("*").alias("row"), self._key().alias("key"),
                           F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("s"))
        return left.join(copies, (F.col("key") == F.col("k")) & (F.col("s") == F.col("salt")), "left").select(
            "row.*", *[F.col(c).alias(n) for c, n in zip(("starts", "stops", "items"), names)])


def look(words: list[str], automata: list[Automaton]) -> tuple[list[tuple[int, int]], set]:
    """Hit spans of ``words`` and the items found by any of the automata."""
    spans, found = [], set()
    for a in automata:
        s, f = a.spans(words)
        spans += s
        found |= f
    return union(spans), found


def known_of(batch: pa.RecordBatch):
    """Per row the spans and items that earlier groups found: the batch's last three columns."""
    for starts, stops, items in zip(*[c.to_pylist() for c in batch.columns[-3:]]):
        yield list(zip(starts or [], stops or [])), set(items or [])


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
          item_id: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, n_words, n_hit, n_items, items_sha256, contaminated and the hit ``spans``
    (word positions [from, to)) of every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    search = Search(docs, benchmark, window, "text", item_id, block_words)
    automata = search.last
    schema = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
              "contaminated boolean, spans array<struct<start:int,stop:int>>")
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("n_items", pa.int64()), ("items_sha256", pa.string()),
                       ("contaminated", pa.bool_()),
                       ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def run(batches):
        found_by = [Automaton.of(a) for a in automata.value]
        for batch in batches:
            out = []
            for ident, t, (spans, found) in zip(batch.column(0).to_pylist(), batch.column(1), known_of(batch)):
                words = words_of(t.as_py())
                here, items = look(words, found_by)
                spans, found = union(spans + here), found | items
                hit = sum(b - a for a, b in spans)
                sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                out.append({"doc_id": ident, "n_words": len(words), "n_hit": hit,
                            "n_items": len(found), "items_sha256": sha, "contaminated": hit > 0,
                            "spans": [{"start": a, "stop": b} for a, b in spans]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return search.rows(docs).mapInArrow(run, schema)


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the hit spans; a document goes when hits cover over ``max_coverage`` of its
    words.  The text outside the spans stays as it is; ``n_chars`` follows the text if present."""
    search = Search(docs, benchmark, window, "text", "item_id", block_words)
    automata = search.last
    names = docs.columns
    at = docs.columns.index("text")
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(text, spans, found_by):
        if not text:
            return text, True
        found = list(WORD.finditer(text.translate(LOWER_TABLE)))
        words = [m.group() for m in found]
        spans = union(spans + look(words, found_by)[0])
        if not spans:
            return text, True
        if sum(b - a for a, b in spans) > max_coverage * len(words):
            return text, False
        parts, pos = [], 0
        for a, b in spans:
            parts.append(text[pos:found[a].start()])
            pos = found[b - 1].end()
        return "".join(parts) + text[pos:], True

    def run(batches):
        found_by = [Automaton.of(a) for a in automata.value]
        for batch in batches:
            done = [cut(t.as_py(), spans, found_by) for t, (spans, _) in zip(batch.column(at), known_of(batch))]
            columns = list(batch.columns[:-3])
            columns[at] = pa.array([t for t, _ in done], pa.string()).cast(columns[at].type)
            if count_at is not None:
                old = columns[count_at].to_pylist()
                before = batch.column(at).to_pylist()
                columns[count_at] = pa.array(
                    [o if t == b or t is None else len(t) for o, b, (t, _) in zip(old, before, done)],
                    columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(
                pa.array([k for _, k in done], pa.bool_()))

    return search.rows(docs).mapInArrow(run, docs.schema)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match(table(spark, sf_dir, "documents"),
                 table(spark, sf_dir, "benchmark")).drop("spans")


ORACLE = r"""
WITH up AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark, up),
item_at AS (
  SELECT item, w, least(len(w), 10) AS n,
         unnest(range(1, CAST(len(w) - least(len(w), 10) + 2 AS BIGINT))) AS i
  FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT n, item, array_to_string(w[i:i + n - 1], ' ') AS gram FROM item_at),
sizes AS (SELECT DISTINCT n FROM win),
doc AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, up),
doc_at AS (
  SELECT rid, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
  FROM doc, sizes WHERE len(w) >= n),
hit AS (
  SELECT rid, i, doc_at.n, item FROM doc_at
  JOIN win ON win.n = doc_at.n AND win.gram = array_to_string(w[i:i + doc_at.n - 1], ' ')),
place AS (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit)),
covered AS (SELECT rid, count(*) AS n_hit FROM place GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)"""
