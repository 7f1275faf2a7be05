"""Token ids in a grammar-compressed binary format with random access.

Documents are sorted by ``doc_id`` over shards (ranges of ids), tokenised and given an end id.  A
shard is a sequence of blocks of about ``BLOCK_TOKENS`` ids.  In each block Re-Pair replaces the
most frequent adjacent pairs by nonterminals, many a round, with exact counts, until no pair is frequent or no symbol is free; no pair goes across the
end of a document.  A block's record keeps:

    shard, block, start     place of the block; ids of the shard before it
    doc_ids                 little-endian int64 per document (``null_ids``: positions of nulls)
    doc_at                  little-endian uint32: first symbol of each document
    doc_tokens              little-endian uint32: ids of each document
    rules                   left and right symbol of each nonterminal, in order of creation
    spans                   little-endian uint32: ids each nonterminal stands for
    symbols                 the compressed sequence
    first_rule, width       number of the first nonterminal; bytes per symbol (2 or 4)

Records are rows of a Parquet table, written by Spark into the shared folder, so lost executors
cost a retry and half-written files are never read.  ``decode_document`` expands one document
without touching the rest of its block.

The tokenizer's cost is paid once per distinct piece: texts of plain Latin-1 characters are cut by
the tokenizer's own splitting rule and the ids of each piece come from a bounded memory (by the
piece's 64-bit hash); all other texts go through the tokenizer whole.

Defined results: null and empty texts have the end id alone; null ids sort first; repeated ids are
ordered by text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from simcat.llm.circulant import BASE, mix64
from simcat.llm.common import shared_path, small_batches, table

END = 2
BLOCK_TOKENS = 1_000_000
PAIRS_PER_ROUND = 2048
BUCKET_BITS = 18
MIN_COUNT = 4            # a rule is stored as two symbols and a span: the room of four symbols
PIECES_KEPT = 1 << 20

# Texts of these characters (Latin-1, after lower-casing) are cut here exactly as the tokenizer
# cuts them: runs of letters, single digits, runs of other signs.  Any other text, and one with an
# apostrophe (contractions) or a special token's "<|", is tokenised whole.
SPACES = b"\t\n\x0b\x0c\r "
DIGITS = b"0123456789"
LETTERS = bytes(range(97, 123)) + bytes(range(0xDF, 0xF7)) + bytes(range(0xF8, 0x100))
SIGNS = bytes(c for c in range(33, 127) if c not in DIGITS + LETTERS + b"'" and not 65 <= c <= 90)
KIND = np.zeros(256, dtype=np.uint8)
for _kind, _chars in ((1, LETTERS), (2, DIGITS), (3, SIGNS)):
    KIND[list(_chars)] = _kind
PLAIN = SPACES + DIGITS + LETTERS + SIGNS
WORD_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)      # the first n bytes of a word


class Pieces:
    """Ids of pieces by the 64-bit hash of the piece; a bounded open-addressing table in numpy."""

    BITS = 21

    def __init__(self, dtype):
        self.dtype = dtype
        self.clear()

    def clear(self):
        self.keys = np.zeros(1 << self.BITS, dtype=np.uint64)
        self.values = np.zeros(1 << self.BITS, dtype=np.int32)
        self.n, self.used = 0, 0
        self.at = np.zeros(PIECES_KEPT, dtype=np.int64)
        self.size = np.zeros(PIECES_KEPT, dtype=np.int64)
        self.flat = np.zeros(1 << 16, dtype=self.dtype)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 if unknown."""
        mask = np.int64((1 << self.BITS) - 1)
        slot = (h & np.uint64(mask)).astype(np.int64)
        out = np.full(len(h), -1, dtype=np.int64)
        todo = np.arange(len(h))
        while len(todo):
            k = self.keys[slot[todo]]
            hit = k == h[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (k != 0)]
            slot[todo] = (slot[todo] + 1) & mask
        return out

    def add(self, h: np.ndarray, ids: list[list[int]]):
        """Store pieces that are not in the table yet."""
        mask = np.int64((1 << self.BITS) - 1)
        number = np.arange(self.n, self.n + len(h), dtype=np.int32)
        slot = (h & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            self.keys[slot[free]] = h[free]
            won = self.keys[slot[todo]] == h[todo]
            self.values[slot[todo[won]]] = number[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & mask
        new = np.fromiter(chain.from_iterable(ids), dtype=self.dtype)
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        size = np.array([len(x) for x in ids], dtype=np.int64)
        self.at[self.n:self.n + len(h)] = self.used + np.cumsum(size) - size
        self.size[self.n:self.n + len(h)] = size
        self.flat[self.used:self.used + len(new)] = new
        self.used += len(new)
        self.n += len(h)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has."""
        size = self.size[numbers]
        first = np.cumsum(size) - size
        place = np.repeat(self.at[numbers] - first, size) + np.arange(int(size.sum()))
        return self.flat[place], size


def _piece_hashes(joined: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash per piece of ``joined``, eight bytes at a time."""
    padded = joined + bytes(8)
    words = np.ndarray(len(joined) + 1, dtype="<u8", buffer=padded, strides=(1,))
    h = length.astype(np.uint64)
    at, left, todo = start, length, None
    while len(at):
        word = words[at] & WORD_MASK[np.minimum(left, 8)]
        if todo is None:
            h = mix64(h * BASE + word)
        else:
            h[todo] = mix64(h[todo] * BASE + word)
        more = np.flatnonzero(left > 8)
        todo = more if todo is None else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return h


class Encoder:
    """Ids of texts; ``spec`` is the tokenizer's JSON."""

    def __init__(self, spec: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocab <= 60_000 else "<u4")
        self.pieces = Pieces(self.dtype)
        self.cut_here = self._cuts_like_pieces(spec)
        # the model knows letters beyond ASCII by the spelling that the tokenizer's ByteLevel step gives them
        self.spelling = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0]
                         for c in LETTERS if c > 127} if self.cut_here else {}

    @staticmethod
    def _cuts_like_pieces(spec: str) -> bool:
        """Whether the tokenizer lower-cases and splits by the rule that KIND follows."""
        return "'s|'t|'re|'ve|'m|'ll|'d|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in spec \
            and '"Lowercase"' in spec and '"end_of_word_suffix":"</w>"' in spec

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Pieces are cut and lower-case already, so the tokenizer's model merges them as they are."""
        merge, spelt = self.tokenizer.model.tokenize, self.spelling
        return [[t.id for t in merge(p if p.isascii() else p.translate(spelt))] for p in pieces]

    def _plain(self, text: str) -> bytes | None:
        """The lower-cased text in Latin-1 if it can be cut here."""
        if not self.cut_here or "<|" in text:
            return None
        try:
            raw = text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if raw.translate(None, PLAIN) else raw

    def _cut(self, raws: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts, all at once."""
        joined = b" ".join(raws) + b" "
        b = np.frombuffer(joined, dtype=np.uint8)
        kind = KIND[b]
        inside = kind != 0
        # a piece begins or ends where the kind changes, and around every digit
        changes = np.diff(kind, prepend=0) != 0
        changes |= kind == 2
        edge = np.flatnonzero(changes)
        start = edge[inside[edge]]
        length = np.append(edge[1:], len(b))[inside[edge]] - start
        if not len(start):
            return [np.empty(0, self.dtype) for _ in raws]
        h = _piece_hashes(joined, start, length)
        h |= np.uint64(1)                         # 0 marks a free place in the table
        number = self.pieces.find(h)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, at = np.unique(h[missing], return_index=True)
            if self.pieces.n + len(new) > PIECES_KEPT:
                self.pieces.clear()               # the memory is bounded; forgetting costs time only
                missing = np.arange(len(h))
                new, at = np.unique(h, return_index=True)
            if len(new) > PIECES_KEPT:
                return self._halves(raws)
            at = missing[at]
            texts = [joined[x:x + n].decode("latin-1")
                     for x, n in zip(start[at].tolist(), length[at].tolist())]
            self.pieces.add(new, self._ids_of_pieces(texts))
            number[missing] = self.pieces.find(h[missing])
        ids, size = self.pieces.ids(number)
        ends = np.cumsum([len(r) + 1 for r in raws])
        upto = np.concatenate(([0], np.cumsum(size)))[np.searchsorted(start, ends)]
        return [ids[x:y] for x, y in zip([0, *upto[:-1].tolist()], upto.tolist())]

    def _halves(self, raws: list[bytes]) -> list[np.ndarray]:
        """More distinct pieces than the memory holds: fewer texts at a time."""
        if len(raws) == 1:
            return self._ids([raws[0].decode("latin-1")])
        m = len(raws) // 2
        return self._cut(raws[:m]) + self._cut(raws[m:])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        whole, cut = [], []
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.empty(0, self.dtype)
                continue
            raw = self._plain(t)
            if raw is None:
                whole.append(i)
            else:
                cut.append((i, raw))
        if whole:
            for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
                out[i] = ids
        if cut:
            for (i, _), ids in zip(cut, self._cut([r for _, r in cut])):
                out[i] = ids
        return out


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(spec: str) -> Encoder:
    """One encoder per worker process, so the pieces learned in a task serve the next ones."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec)
    return _ENCODERS[key]


def _bucket(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pairs (a, b) of BUCKET_BITS bits."""
    h = a * np.uint32(0x9E3779B1)
    h ^= b * np.uint32(0x85EBCA77)
    h >>= np.uint32(32 - BUCKET_BITS)
    return h


def _apart(place: np.ndarray) -> np.ndarray:
    """Of overlapping places every second one of a run, from the left."""
    take = np.ones(len(place), dtype=bool)
    follows = np.flatnonzero(place[1:] - place[:-1] == 1) + 1      # few: most places stand alone
    if len(follows):
        first = np.diff(follows, prepend=-1) != 1
        nth = np.arange(len(follows))
        nth -= np.maximum.accumulate(np.where(first, nth, 0))
        take[follows] = nth % 2 == 1
    return take


def compress(seq: np.ndarray, first_rule: int, end: int = END):
    """Re-Pair of ``seq``: (symbols, rules as an (n, 2) array, ids per rule).

    Ends when no pair has MIN_COUNT places, or when all symbols of the width are in use.
    """
    most = (1 << 16) if first_rule <= 60_000 else (1 << 24)
    seq = seq.astype(np.uint32)
    rules: list[np.ndarray] = []
    spans: list[np.ndarray] = []
    number = first_rule
    every = False            # count the pairs of all buckets that could hold one
    while number < most and len(seq) > MIN_COUNT:
        a, b = seq[:-1], seq[1:]
        # counts by hash bucket first; only the pairs of the largest buckets are counted exactly
        bucket = _bucket(a, b).astype(np.intp)
        size_of = np.bincount(bucket, minlength=1 << BUCKET_BITS)
        bar = MIN_COUNT if every else max(
            MIN_COUNT, int(np.partition(size_of, -2 * PAIRS_PER_ROUND)[-2 * PAIRS_PER_ROUND]))
        large = (size_of >= bar)[bucket]
        ends = seq == end
        large &= ~(ends[:-1] | ends[1:])
        place = np.flatnonzero(large)
        if most <= 65536:
            code = (a[place] << np.uint32(16)) | b[place]
        else:
            code = (a[place].astype(np.uint64) << np.uint64(32)) | b[place]
        ordered = np.sort(code)
        at = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - ordered.dtype.type(1)))
        count = np.diff(at, append=len(ordered))
        often = np.flatnonzero(count >= MIN_COUNT)
        if not len(often) and bar > MIN_COUNT:
            every = True
            continue
        if not len(often):
            break
        every = False
        room = min(PAIRS_PER_ROUND, most - number)
        # most frequent first; equal counts by the pair itself
        often = often[np.lexsort((ordered[at[often]], -count[often]))][:room]
        often = np.sort(often)
        pairs = ordered[at[often]]
        shift = pairs.dtype.type(32 if most > 65536 else 16)
        left, right = pairs >> shift, pairs & pairs.dtype.type((1 << int(shift)) - 1)
        # one pair per bucket is found at once; another one of the bucket waits for a later round
        slot = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
        slot[_bucket(left.astype(np.uint32), right.astype(np.uint32))] = np.arange(len(pairs))
        which = slot[bucket[place]]
        hit = np.flatnonzero(pairs[which] == code)
        place, which = place[hit], which[hit]
        take = _apart(place)
        uses = np.bincount(which[take], minlength=len(pairs))
        # a pair that loses most of its places to others waits for a later round
        good = 2 * uses >= count[often]
        good[int((count[often] * (uses > 0)).argmax())] = True
        wait = ~good[which]
        if wait.any():
            place, which = place[~wait], which[~wait]
            take = _apart(place)
        place, which = place[take], which[take]
        used = np.bincount(which, minlength=len(pairs)) > 0
        pairs, which = pairs[used], (np.cumsum(used) - 1)[which]
        left, right = left[used].astype(np.int64), right[used].astype(np.int64)
        known = np.concatenate(spans) if spans else np.empty(0, np.uint32)
        size = lambda s: np.where(s < first_rule, 1, known[np.maximum(s - first_rule, 0)]
                                  if len(known) else 1)
        spans.append((size(left) + size(right)).astype(np.uint32))
        rules.append(np.stack([left, right], axis=1))
        seq[place] = number + which
        keep = np.ones(len(seq), dtype=bool)
        keep[place + 1] = False
        seq = seq[keep]
        number += len(pairs)
    empty = np.empty((0, 2), np.int64)
    return (seq, np.concatenate(rules) if rules else empty,
            np.concatenate(spans) if spans else np.empty(0, np.uint32))


def expansions(rules: np.ndarray, spans: np.ndarray, first_rule: int):
    """All nonterminals written out: (start of each, ids)."""
    start = np.cumsum(spans, dtype=np.int64) - spans
    flat = np.empty(int(spans.sum()), dtype=np.uint32)
    done = np.zeros(len(rules), dtype=bool)
    todo = np.arange(len(rules))
    while len(todo):
        # the rules whose both symbols are written out, all at once
        pair = rules[todo]
        rule = np.maximum(pair - first_rule, 0)
        terminal = pair < first_rule
        ready = (terminal | done[rule]).all(axis=1)
        now, pair, rule, terminal = todo[ready], pair[ready], rule[ready], terminal[ready]
        at = start[now]
        for side in (0, 1):
            ids = terminal[:, side]
            flat[at[ids]] = pair[ids, side]
            others = rule[~ids, side]
            size = spans[others].astype(np.int64)
            first = np.cumsum(size) - size
            step = np.arange(int(size.sum()))
            flat[np.repeat(at[~ids] - first, size) + step] = flat[np.repeat(start[others] - first, size) + step]
            at = at + np.where(ids, 1, spans[rule[:, side]])
        done[now] = True
        todo = todo[~ready]
    return start, flat


def expand(seq: np.ndarray, spans, start, flat, first_rule: int) -> np.ndarray:
    seq = seq.astype(np.int64)
    if not len(seq) or not len(spans):
        return seq.astype(np.uint32)
    rule = np.maximum(seq - first_rule, 0)
    terminal = seq < first_rule
    size = np.where(terminal, 1, spans.astype(np.int64)[rule])
    first = np.cumsum(size) - size
    source = np.repeat(np.where(terminal, 0, start[rule]) - first, size) + np.arange(int(size.sum()))
    out = flat[source]
    out[first[terminal]] = seq[terminal]
    return out


class Block:
    """A record of the file format."""

    def __init__(self, row: dict):
        self.row = row
        kind = np.dtype("<u2" if row["width"] == 2 else "<u4")
        self.first_rule = row["first_rule"]
        self.symbols = np.frombuffer(row["symbols"], dtype=kind)
        self.rules = np.frombuffer(row["rules"], dtype=kind).reshape(-1, 2).astype(np.int64)
        self.spans = np.frombuffer(row["spans"], dtype="<u4")
        self.doc_at = np.frombuffer(row["doc_at"], dtype="<u4")
        self.doc_tokens = np.frombuffer(row["doc_tokens"], dtype="<u4").astype(np.int64)
        ids = np.frombuffer(row["doc_ids"], dtype="<i8").tolist()
        null = set(np.frombuffer(row["null_ids"], dtype="<u4").tolist())
        self.doc_ids = [None if i in null else x for i, x in enumerate(ids)]
        self.start, self.flat = expansions(self.rules, self.spans, self.first_rule)

    def decode_document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, from its own symbols alone."""
        to = self.doc_at[i + 1] if i + 1 < len(self.doc_at) else len(self.symbols)
        return expand(self.symbols[self.doc_at[i]:to], self.spans, self.start, self.flat,
                      self.first_rule)

    def decode(self) -> np.ndarray:
        return expand(self.symbols, self.spans, self.start, self.flat, self.first_rule)


BLOCK_SCHEMA = ("shard int, block int, start long, n_tokens long, doc_ids binary, null_ids binary, "
                "doc_at binary, doc_tokens binary, rules binary, spans binary, symbols binary, "
                "first_rule int, width int")
ARROW_SCHEMA = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64())]
    + [(c, pa.binary()) for c in ("doc_ids", "null_ids", "doc_at", "doc_tokens", "rules", "spans",
                                  "symbols")]
    + [("first_rule", pa.int32()), ("width", pa.int32())])


def make_block(shard, block, start, ids: list, seqs: list[np.ndarray], first_rule: int, end: int) -> dict:
    seq = np.concatenate(seqs)
    symbols, rules, spans = compress(seq, first_rule, end)
    kind = np.dtype("<u2" if first_rule <= 60_000 else "<u4")
    # the end id may be an ordinary token too, so documents are found by their lengths
    lengths = np.array([len(s) for s in seqs], dtype=np.int64)
    size = np.ones(len(symbols), dtype=np.int64)
    big = symbols >= first_rule
    size[big] = spans[symbols[big] - first_rule]
    after = np.cumsum(size)
    doc_at = np.searchsorted(after, np.cumsum(lengths) - lengths, side="right")
    null = [i for i, x in enumerate(ids) if x is None]
    return {"shard": shard, "block": block, "start": start, "n_tokens": int(lengths.sum()),
            "doc_ids": np.array([x or 0 for x in ids], dtype="<i8").tobytes(),
            "null_ids": np.array(null, dtype="<u4").tobytes(),
            "doc_at": doc_at.astype("<u4").tobytes(), "doc_tokens": lengths.astype("<u4").tobytes(),
            "rules": rules.astype(kind).tobytes(), "spans": spans.astype("<u4").tobytes(),
            "symbols": symbols.astype(kind).tobytes(), "first_rule": first_rule,
            "width": kind.itemsize}


def write(docs: DataFrame, tokenizer_json: str, path: str, end: int = END,
          shards: int | None = None, text: str = "text") -> None:
    """Write the documents' ids to ``path`` in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    small_batches(spark)
    spec = spark.sparkContext.broadcast(tokenizer_json)     # one file of fixed size
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
            .repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text"))

    def run(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        encoder = encoder_of(spec.value)
        first_rule = encoder.vocab
        stop = np.array([end], dtype=encoder.dtype)
        ids, seqs, held, block, start = [], [], 0, 0, 0

        def record():
            return pa.RecordBatch.from_pylist(
                [make_block(shard, block, start, ids, seqs, first_rule, end)], schema=ARROW_SCHEMA)

        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            for ident, seq in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids.append(ident)
                seqs.append(np.append(seq, stop))
                held += len(seq) + 1
                if held >= BLOCK_TOKENS:
                    yield record()
                    block, start = block + 1, start + held
                    ids, seqs, held = [], [], 0
        if ids:
            yield record()

    rows.mapInArrow(run, BLOCK_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32, and its shard, block and number in the block."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per shard; the number of shards is a parameter of write()
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .cast("long").alias("before"))
    schema = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("shard", pa.int32()), ("block", pa.int32()),
                        ("number", pa.int32())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({k: batch.column(k)[i].as_py() for k in batch.schema.names})
                ids = block.decode().astype("<u4")
                size = block.doc_tokens
                at = np.cumsum(size) - size
                crc = [zlib.crc32(ids[a:a + n].data) for a, n in zip(at.tolist(), size.tolist())]
                n = len(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64()), pa.array(at + block.row["start"]),
                     pa.array(size), pa.array(crc, pa.int64()),
                     pa.array(np.full(n, block.row["shard"], np.int32)),
                     pa.array(np.full(n, block.row["block"], np.int32)),
                     pa.array(np.arange(n, dtype=np.int32))], schema=schema)

    docs = blocks.mapInArrow(run, "doc_id long, at long, n_tokens long, ids_crc32 long, shard int, "
                                  "block int, number int")
    return (docs.join(before, "shard")
            .select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens",
                    "ids_crc32", "shard", "block", "number"))


def tokenizer_json(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-ids")
    write(table(spark, sf_dir, "documents"), tokenizer_json(), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
