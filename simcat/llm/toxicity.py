"""Toxicity scores from a learned lexicon, matched by Levenshtein automata over its trie.

The lexicon is learned from labelled rows of the training fold: words, and stems that many
different words begin with, which stand out in toxic texts.  A stem may need two or three different
words of one text: where ordinary words share the stem now and then, only their number tells.  A trie of the lexicon is intersected
with Levenshtein automata: a state is a set of (trie node, edits so far), made on demand and kept,
so every word of a text costs a few table look-ups and misspelled terms are found too.  Each hit
is looked at in a window of words around it, which tells quotation from abuse.  Entry, number of
edits, context and whether the stem has its number of words give the hit a precision learned from the labels; a text's score is the chance
that at least one of its hits is abuse.

Parameter: ``MAX_FIT`` bounds the labelled rows used for fitting (the smallest hashes of doc_id,
so the choice doesn't depend on partitioning), and with them the lexicon: every term of these rows
that passes the tests is an entry.

Defined results: null, empty and wordless texts get the score of texts without a hit; of repeated
labels for a document the highest counts; without toxic training rows every score is the base
rate 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from simcat.llm.common import crc_mod, materialise, small_batches, table, tasks_for

FOLDS, HELD_OUT = 4, 2
MAX_FIT = 20_000
CUT = 0.3
STEM = (4, 5, 6, 7)
REPEATS = 3              # different words of a text that an entry may ask of its stem
MIN_POSITIVE = 5         # fewer toxic texts can't reach MIN_GAIN
MIN_RATIO = 20           # share of the toxic texts against share of the others
MIN_GAIN = 27.0          # log-likelihood ratio of a lexicon entry
MIN_PRECISION = 0.6      # less precise hits order the texts below CUT, but never reject one
WINDOW = 8               # words looked at on either side of a hit
LONGEST = 40             # longest words of a text, which tell texts apart when copies are left out
SEEN = 1 << 19           # words remembered as clean by one worker
WORD = re.compile(r"\w+")
QUOTES = re.compile(r"[\"“”„«»‹›]|(?<!\w)'|'(?!\w)")
REPORTING = frozenset(
    "said says quote quoted quotes wrote word words term called slur insult means sagte wort zitat "
    "schrieb nannte dit mot citation dijo palabra cita escribió".split())
YOU = frozenset("you your yours u du dich dein deine ihr euch tu te ton ta vous votre tú ti tu eres "
                "usted vosotros".split())


def allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 9 else 2


class Lexicon:
    """Trie of the entries and the lazily built automaton of words near them.

    An entry is a term and the number of different words of a text that must begin with it; 0 for a
    whole word.
    """

    def __init__(self, entries: list[tuple[str, int]]):
        self.entries = entries
        self.kids: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most = [0]
        for e, (term, stem) in enumerate(entries):
            most = (1 if len(term) >= 6 else 0) if stem else allowed(len(term))
            node = 0
            self.most[0] = max(self.most[0], most)
            for c in term:
                if c not in self.kids[node]:
                    self.kids[node][c] = len(self.kids)
                    self.kids.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = self.kids[node][c]
                self.most[node] = max(self.most[node], most)
            self.ends[node].append(e)
        self.limit = [(1 if len(t) >= 6 else 0) if s else allowed(len(t)) for t, s in entries]
        self.states: list[tuple] = []
        self.ids: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.accept: list[list[tuple[int, int]]] = []
        self.stems: list[list[tuple[int, int]]] = []
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes.items())
        best: dict[int, int] = {}
        while todo:                       # a letter of the term that the word leaves out
            node, edits = todo.pop()
            if edits > self.most[node] or best.get(node, 99) <= edits:
                continue
            best[node] = edits
            todo += [(kid, edits + 1) for kid in self.kids[node].values()]
        key = frozenset(best.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(tuple(best.items()))
            self.moves.append({})
            hits = [(e, edits) for node, edits in best.items() for e in self.ends[node]
                    if edits <= self.limit[e]]
            self.accept.append([h for h in hits if not self.entries[h[0]][1]])
            self.stems.append([h for h in hits if self.entries[h[0]][1]])
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}

        def put(node, edits):
            if edits <= self.most[node] and edits < nodes.get(node, 99):
                nodes[node] = edits

        for node, edits in self.states[state]:
            put(node, edits + 1)                      # a letter too many
            for letter, kid in self.kids[node].items():
                put(kid, edits if letter == c else edits + 1)
        to = self._state(nodes)
        self.moves[state][c] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The nearest entry of ``word`` as (entry, edits), or None."""
        state, found = self.start, None
        moves, dead = self.moves, self.dead
        for c in word:
            to = moves[state].get(c)
            state = to if to is not None else self._move(state, c)
            if state == dead:
                return found
            for e, edits in self.stems[state]:
                if found is None or edits < found[1]:
                    found = (e, edits)
        for e, edits in self.accept[state]:
            if found is None or edits <= found[1]:
                found = (e, edits)
        return found


class Scanner:
    """Hits of texts, with a memory of words seen before."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.clean: set[str] = set()
        self.known: dict[str, tuple[int, int]] = {}

    def hits(self, text: str | None) -> set[tuple[int, int, bool, bool]]:
        """(entry, edits, quoted, enough words of the stem) of every hit."""
        if not text:
            return set()
        low = text.lower()
        words = set(WORD.findall(low))
        new = words - self.clean
        near = set()
        for w in new:
            m = self.known.get(w) or self.lexicon.match(w)
            if m:
                self.known[w] = m
                near.add(w)
        # memories are bounded; forgetting costs time only
        if len(self.known) > SEEN:
            self.known = {w: self.known[w] for w in near}
        self.clean |= new.difference(near)
        if len(self.clean) > SEEN:
            self.clean = set()
        if not near:
            return set()
        several = Counter(self.known[w] for w in near)
        found = set()
        at = [m.span() for m in WORD.finditer(low)]
        for i, (start, stop) in enumerate(at):
            word = low[start:stop]
            if word not in near:
                continue
            left, right = at[max(0, i - WINDOW):i], at[i + 1:i + 1 + WINDOW]
            around = [low[a:b] for a, b in left + right]
            # signs before the first and after the last of these words count too
            before = low[at[i - WINDOW - 1][1] if i > WINDOW else 0:start]
            after = low[stop:at[i + 1 + WINDOW][0] if i + 1 + WINDOW < len(at) else len(low)]
            marked = len(QUOTES.findall(before)) % 2 == 1 and QUOTES.search(after) is not None
            quoted = (marked or not REPORTING.isdisjoint(around)) and YOU.isdisjoint(around)
            entry, edits = self.known[word]
            found.add((entry, edits, quoted, several[entry, edits] >= self.lexicon.entries[entry][1]))
        return found


def _gain(pos: int, neg: int, n_pos: int, n_neg: int) -> float:
    """Log-likelihood ratio of a term's counts against the classes' shares."""
    total, share = pos + neg, n_pos / (n_pos + n_neg)
    if not total or pos / total <= share:
        return 0.0
    out = pos * math.log(pos / (total * share))
    return 2 * (out + neg * math.log(neg / (total * (1 - share)))) if neg else 2 * out


def terms_of(text: str | None) -> set[str]:
    """The words of a text, and its stems with a star for each of up to REPEATS words that have it."""
    words = set(WORD.findall((text or "").lower()))
    stems = Counter(w[:k] for w in words for k in STEM if len(w) > k)
    return words | {t + "*" * n for t, most in stems.items() for n in range(1, min(most, REPEATS) + 1)}


def choose(counts: list[tuple[str, int, int]], n_pos: int, n_neg: int) -> list[tuple[str, int]]:
    """Lexicon entries (term, words its stem needs or 0) from rows (term, toxic docs, other docs)."""
    gain = {t: _gain(p, n, n_pos, n_neg) for t, p, n in counts}
    sure = {t for t, p, n in counts if gain[t] >= MIN_GAIN
            and p / n_pos >= MIN_RATIO * (n + 0.5) / (n_neg + 1)}
    words = sorted((t for t in sure if not t.endswith("*")), key=lambda t: (-gain[t], t))
    best_word: dict[str, float] = {}
    for w in words:
        for k in STEM:
            best_word[w[:k]] = max(best_word.get(w[:k], 0.0), gain[w])
    out: list[tuple[str, int]] = []
    taken: set[str] = set()                   # the stems, and all that they begin with
    starts: set[str] = set()
    stars = [(t.rstrip("*"), t.count("*"), gain[t]) for t in sure if t.endswith("*")]
    for stem, n, g in sorted(stars, key=lambda s: (-s[2], -len(s[0]), s[1], s[0])):
        if g > 1.3 * best_word.get(stem, 0.0) and stem not in starts \
                and not any(stem[:k] in taken for k in STEM):
            out.append((stem, n))
            taken.add(stem)
            starts.update(stem[:k] for k in STEM)
    return out + [(w, 0) for w in words if not any(w[:k] in taken for k in STEM)]


def training_rows(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int,
                  limit: int) -> DataFrame:
    """``doc_id``, ``text``, ``y`` of at most ``limit`` labelled rows of the training fold."""
    ids = (labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull()
                         & (crc_mod(F.col("doc_id"), folds) != held_out))
           .groupBy("doc_id").agg(F.max(column).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # at most ``limit`` ids: the size of the broadcast is a parameter
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(ids.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")


def _sketch(batches):
    """A hash that copies and most near copies of a text share: the two smallest of its longest
    words'."""
    for batch in batches:
        out = []
        for t in batch.column("text"):
            text = (t.as_py() or "").lower()
            words = sorted(set(WORD.findall(text)), key=lambda w: (-len(w), w))[:LONGEST] or [text]
            low = sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)
            out.append(low[0] << 31 ^ low[-1 if len(low) == 1 else 1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())],
                                         names=[*batch.schema.names, "sketch"])


def one_of_each(rows: DataFrame) -> DataFrame:
    """The sample without copies: a term must stand out in different texts, not in many copies of
    one.  The sample is written out, so the passes over it don't read the corpus again."""
    sample = materialise(rows.select("doc_id", "y", "text").mapInArrow(
        _sketch, "doc_id long, y int, text string, sketch long"), "toxicity-sample")
    # at most max_fit rows
    first = sample.groupBy("sketch", "y").agg(F.min("doc_id").alias("doc_id"))
    return sample.join(F.broadcast(first), ["sketch", "y", "doc_id"], "left_semi").select(
        "doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT):
    """Lexicon entries, precision per (entry, edits, quoted, enough), score of a text without hits."""
    small_batches(docs.sparkSession)
    rows = one_of_each(training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, max_fit))

    def count(batches):
        pos, neg = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                (pos if y else neg).update(terms_of(t.as_py()))
                (pos if y else neg)[""] += 1
        terms = sorted(pos.keys() | neg.keys())
        for a in range(0, len(terms), 10_000):
            part = terms[a:a + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([pos[t] for t in part], pa.int64()),
                 pa.array([neg[t] for t in part], pa.int64())], names=["term", "pos", "neg"])

    counted = materialise(
        rows.mapInArrow(count, "term string, pos long, neg long").groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxicity-terms",
        tasks_for(docs.sparkSession, max_fit))
    whole = counted.filter(F.col("term") == "").first()
    if whole is None or not whole["pos"]:
        return [], {}, 0.0
    n_pos, n_neg = whole["pos"], whole["neg"]
    often = counted.filter((F.col("term") != "") & (F.col("pos") >= MIN_POSITIVE)
                           & (F.col("pos") / n_pos >= MIN_RATIO * (F.col("neg") + 0.5) / (n_neg + 1)))
    # terms of at least MIN_POSITIVE of at most max_fit texts
    entries = choose([tuple(r) for r in often.select("term", "pos", "neg").collect()], n_pos, n_neg)

    def find(batches):
        scanner = Scanner(Lexicon(entries))
        pos, neg = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                hits = scanner.hits(t.as_py())
                (pos if y else neg).update(hits or {(-1, 0, False, True)})
        keys = sorted(pos.keys() | neg.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([k[2] for k in keys], pa.bool_()), pa.array([k[3] for k in keys], pa.bool_()),
             pa.array([pos[k] for k in keys], pa.int64()), pa.array([neg[k] for k in keys], pa.int64())],
            names=[*kind, "pos", "neg"])

    kind = ["entry", "edits", "quoted", "enough"]
    table_ = {tuple(r[k] for k in kind): (r["pos"], r["neg"]) for r in rows.mapInArrow(
        find, "entry long, edits long, quoted boolean, enough boolean, pos long, neg long")
        .groupBy(*kind)
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}
    base_pos, base_neg = table_.pop((-1, 0, False, True), (0, 0))
    precision = {}
    for e, edits, quoted, enough in product(range(len(entries)), (0, 1, 2), (False, True), (False, True)):
        p, n = table_.get((e, edits, quoted, enough), (0, 0))
        # kinds never seen in training: misspellings count; quotations and too few words don't
        prior = (0.9, 0.75, 0.65)[edits] * (0.3 if quoted else 1.0) * (1.0 if enough else 0.1)
        precision[(e, edits, quoted, enough)] = (p + prior) / (p + n + 1.0)
    return entries, precision, base_pos / max(1, base_pos + base_neg)


def chance(hits, precision: dict, base: float) -> float:
    """Chance that a text with these hits is toxic."""
    sure, weak = 1.0, 1.0
    for hit in hits:
        p = precision[hit]
        if p >= MIN_PRECISION:
            sure *= 1.0 - p
        else:
            weak *= 1.0 - p
    if sure < 1.0:
        return 1.0 - sure * (1.0 - base)
    base = min(base, 0.5 * CUT)
    return base + (0.9 * CUT - base) * (1.0 - weak)


def score(docs: DataFrame, model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` plus ``score``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)     # entries of at most max_fit texts
    source = docs.select(*columns, F.col("text").alias("_text"))
    schema = docs.select(*columns).schema

    def run(batches):
        entries, precision, base = shared.value
        scanner = Scanner(Lexicon(entries))
        for batch in batches:
            out = [chance(scanner.hits(t.as_py()), precision, base)
                   for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())],
                names=[*columns, "score"])

    from pyspark.sql.types import DoubleType, StructType
    return source.mapInArrow(run, StructType(list(schema.fields)).add("score", DoubleType()))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score stays under ``CUT``."""
    model = fit(docs, labels)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        entries, precision, base = shared.value
        scanner = Scanner(Lexicon(entries))
        for batch in batches:
            keep = [chance(scanner.hits(t.as_py()), precision, base) < CUT
                    for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
