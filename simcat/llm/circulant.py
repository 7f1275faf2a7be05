"""Near-duplicate components with circulant MinHash, banding and exact Jaccard verification.

A document's set is its distinct 5-word shingles.  Two permutations of the 32-bit universe make the
whole signature: the first shuffles the shingles, the second is applied after a circular shift by
k for coordinate k.  Bands of ``ROWS`` coordinates give bucket keys; a pair at the threshold 0.85
shares no band with probability 2e-7, one at 0.8 with 3e-5.  Links are decided on the full sets:

1. Texts with equal sets are one vertex, whatever their ``doc_id``.
2. Every bucket has a hub, the member that meets the most others, and each text is compared with
   the best hub of its buckets.  That links nearly all members of a group of variants.  Where a
   bucket still has several components and its members different hubs, all of them are compared
   with the bucket's own hub too, so any two members of a bucket have a hub in common.
3. Members of one hub that are in different components after that are described by what they lack
   of the hub's set and what they have besides it.  The intersection of two of them is the hub's
   size, less what either lacks, plus the differences they share.  So a pair is a link without any
   shared difference only if a sum of two numbers is small, and then both are linked to the member
   with the smallest number: one more comparison each.
4. Every other link needs a known number of shared differences.  By the prefix principle such a
   pair meets in the first few differences of either, the rarest first, which is an equality join;
   those pairs are verified.

All links between members of a bucket are found (and some others), without comparing all its pairs and without a cap.
Pairs inside one component add nothing to it and are not looked for.

Defined results: null, empty and wordless texts have an empty set, n_shingles 0 and a component of
their own; texts of fewer than five words have one shingle; a component is named by its smallest
``doc_id``, and the rows of that id are kept (without an id, and in ``filter_documents``, of several that of the
smallest text hash); a null
``doc_id`` counts as the lowest id and stays null as a name; rows that share a ``doc_id`` (or have
none) are linked by that only if ``one_per_id`` is set, which the query and the pipeline don't;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from simcat.llm.common import hot_join, materialise, measured_joins, small_batches, table, tasks_for

SHINGLE = 5
BANDS, ROWS = 26, 5
THRESHOLD = 85           # per cent of the union, if the caller names none
CHUNK = 1 << 15          # shingles signed at once; fits a core's cache
NULL_ID = 1 - (1 << 63)      # the lowest id that can be negated

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word of ``text`` (A-Z lower-cased, cut at ASCII white space)."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    inside = ~SPACE[raw]
    letters = raw[inside]
    if not len(letters):
        return np.empty(0, dtype=np.uint64)
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    lengths = edge[1::2] - edge[::2]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, dtype=np.uint64))
    return mix64(np.add.reduceat(BYTE_CODE[letters] * powers[place], first)
                  + lengths.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of ``text``."""
    words = word_hashes(text) if text else np.empty(0, dtype=np.uint64)
    if not len(words):
        return words
    n = min(SHINGLE, len(words))
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += words[j:len(words) - n + 1 + j] * PLACE[j]
    return np.unique(mix64(total + np.uint64(n)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Circulant MinHash of non-empty sets: one row of BANDS * ROWS coordinates each."""
    k_all = BANDS * ROWS
    out = np.full((len(sets), k_all), 0xFFFFFFFF, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    # first permutation of the universe
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    for a in range(0, len(x), CHUNK):
        part, own = x[a:a + CHUNK], owner[a:a + CHUNK]
        start = np.flatnonzero(np.diff(own, prepend=-1))
        rows = own[start]
        y, t = np.empty_like(part), np.empty_like(part)
        for k in range(k_all):
            # second permutation, after a circular shift by k
            np.add(part, np.uint32(k), out=y)
            np.right_shift(y, np.uint32(16), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(0x21F0AAAD), out=y)
            np.right_shift(y, np.uint32(15), out=t)
            np.bitwise_xor(y, t, out=y)
            np.multiply(y, np.uint32(0x735A2D97), out=y)
            np.right_shift(y, np.uint32(15), out=t)
            np.bitwise_xor(y, t, out=y)
            out[rows, k] = np.minimum(out[rows, k], np.minimum.reduceat(y, start))
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band (the band's number is part of it)."""
    keys = np.empty((len(sig), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, dtype=np.uint64)
        for r in range(ROWS):
            h = mix64(h * BASE + sig[:, b * ROWS + r].astype(np.uint64))
        keys[:, b] = h
    return keys.view(np.int64)


def _sign(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("n_shingles", pa.int64()),
                        ("fp", pa.binary()), ("bands", pa.list_(pa.int64()))])
    for batch in batches:
        sets = [shingle_set(t.as_py()) for t in batch.column(2)]
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        if full:
            for i, row in zip(full, band_keys(signatures([sets[i] for i in full]))):
                bands[i] = row
        fp = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(fp, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], schema=schema)


def _sets(batches):
    schema = pa.schema([("id", pa.int64()), ("grams", pa.binary())])
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column(1)],
                                       pa.binary())], schema=schema)


def _linked(threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = _grams(x), _grams(y)
                inter = int(_within(p, q).sum())
                keep.append(100 * inter >= threshold * (len(p) + len(q) - inter))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept)], schema=schema)

    return run


def _pointed(edges: DataFrame, key: str, low) -> DataFrame:
    """``edges`` with ``m``, the smallest of ``low`` over the edges of the same ``key``.

    The minima are partial before their exchange, and what follows the join is exchanged anew, so adaptive
    execution may split a vertex with a large share of the edges.
    """
    return edges.join(edges.groupBy(key).agg(F.min(low).alias("m")), key)


def _are_stars(links: DataFrame) -> bool:
    """Every vertex is either a centre or the leaf of one centre."""
    ends = (links.select(F.col("a").alias("id"), F.lit(1).alias("as_leaf"), F.lit(0).alias("as_centre"))
            .union(links.select("b", F.lit(0), F.lit(1))))
    mixed = ends.groupBy("id").agg(F.sum("as_leaf").alias("l"), F.max("as_centre").alias("c")).filter(
        (F.col("l") > 1) | ((F.col("l") > 0) & (F.col("c") > 0)))
    return not mixed.limit(1).count()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the smallest of the vertex and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = _pointed(both, "a", F.least("a", "b"))
    return near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the smallest of them."""
    ends = F.array(*[F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")])
    return (_pointed(edges, "a", F.col("b")).select(F.explode(ends).alias("e")).select("e.*")
            .filter(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """``id``, ``label`` (smallest id reachable) for every vertex of ``edges`` (a, b).

    Large-star and small-star steps in turn (Kiveris and others, 2014) until the edges are stars around
    the smallest ids: a few rounds, growing with the logarithm of the longest chain.  Links always point
    from a larger to a smaller id, so a star's centre is its smallest.  Every step is written out; nothing
    is collected but a count.  Tables are written in ``tasks`` tasks at most, or as many as the edges need.
    """
    found = materialise(edges.select("a", "b"), "links", tasks)
    tasks = tasks or tasks_for(edges.sparkSession, found.count())
    links = materialise(found.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", tasks)
    while not _are_stars(links):
        links = materialise(_large_star(links), "links", tasks)
        links = materialise(_small_star(links), "links", tasks)
    own = found.select(F.explode(F.array("a", "b")).alias("id")).union(links.select("b"))
    return materialise(links.select(F.col("a").alias("id"), F.col("b").alias("label")).union(
        own.select("id", F.col("id").alias("label"))).groupBy("id").agg(F.min("label").alias("label")), "labels", tasks)


def _compare(batches):
    """Sizes and the part of the hub's set that a member lacks."""
    schema = pa.schema([("hub", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
                        ("lacks", pa.int64())])
    for batch in batches:
        h, n, lacks = [], [], []
        for x, y in zip(batch.column(2), batch.column(3)):
            hub, own = _grams(x), _grams(y)
            h.append(len(hub))
            n.append(len(own))
            lacks.append(len(hub) - int(_within(own, hub).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(v, pa.int64()) for v in (h, n, lacks)]],
            schema=schema)


def _differences(batches):
    """What a member has besides its hub's set, and what it lacks of it."""
    schema = pa.schema([("hub", pa.int64()), ("id", pa.int64()), ("gram", pa.int64())])
    for batch in batches:
        out, size = [np.empty(0, np.uint64)], []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = _grams(x), _grams(y)
            out += [b[~_within(b, a)], a[~_within(a, b)]]
            size.append(len(out[-1]) + len(out[-2]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(c).to_numpy(), size), pa.int64()) for c in (0, 1)]
            + [pa.array(np.concatenate(out).view(np.int64))], schema=schema)


def _grams(x) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), dtype=np.uint64)


def _within(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which of the sorted ``p`` are in the sorted, non-empty ``q``."""
    at = np.searchsorted(q, p)
    at[at == len(q)] = 0
    return q[at] == p


def _with_sets(pairs: DataFrame, sets: DataFrame, a: str, b: str) -> DataFrame:
    return (pairs.join(sets.select(F.col("id").alias(b), F.col("grams").alias(f"grams_{b}")), b)
            .join(sets.select(F.col("id").alias(a), F.col("grams").alias(f"grams_{a}")), a))


def _join_up(labels: DataFrame | None, links: DataFrame, tasks: int | None = None) -> DataFrame | None:
    """Components after adding ``links`` (a, b)."""
    if not links.limit(1).count():
        return labels
    if labels is not None:
        links = links.union(labels.filter(F.col("id") != F.col("label")).select("label", "id"))
    return components(links, tasks)


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of ``id``."""
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of the hubs whose members are in several components."""
    several = (rows.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
               .filter(F.col("lo") != F.col("hi")).select("hub"))
    return rows.join(several, "hub", "left_semi")


def _members(groups: DataFrame, tasks: int) -> DataFrame:
    """(key, id, hub) of every member of a shared bucket; the hub is the member that meets most."""
    postings = groups.select("id", F.explode("bands").alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = materialise(postings.join(shared, "key"), "members", tasks)
    meets = members.groupBy("id").agg(F.sum("c").alias("meets"))
    hubs = (members.join(meets, "id").groupBy("key")
            .agg(F.max(F.struct("meets", (-F.col("id")).alias("low"))).alias("top")))
    return members.join(hubs, "key").select("key", "id", "top")


def _star(docs: DataFrame, pairs: DataFrame, tasks: int) -> DataFrame:
    return materialise(_with_sets(pairs, docs, "hub", "id").select("hub", "id", "grams_hub", "grams_id")
                       .coalesce(tasks).mapInArrow(_compare, "hub long, id long, h long, n long, lacks long"), "star")


def link(docs: DataFrame, groups: DataFrame, threshold: int = THRESHOLD) -> DataFrame | None:
    """``id``, ``label`` of the vertices that have a link; None if none has.

    ``docs`` has doc_id, sha, text; ``groups`` a vertex per set: id, first (doc_id, sha), bands.
    """
    # 100 * I >= threshold * (n + m - I), multiplied out: whole * I >= threshold * (n + m)
    whole = 100 + threshold
    tasks = tasks_for(docs.sparkSession, groups.count())
    members = materialise(_members(groups, tasks), "bucket-members", tasks)
    hub = (-F.col("top.low")).alias("hub")
    # one hub for each member: the best of those of its buckets
    own = materialise(members.groupBy("id").agg(F.max("top").alias("top")).select("id", hub), "own-hubs", tasks)
    wanted = groups.select("id", "first.doc_id", "first.sha").join(own.select("id"), "id", "left_semi")
    sets = materialise(docs.join(wanted, ["doc_id", "sha"]).dropDuplicates(["doc_id", "sha"])
                       .select("id", "text").coalesce(tasks).mapInArrow(_sets, "id long, grams binary"), "sets")
    star = _star(sets, own.filter(F.col("hub") != F.col("id")), tasks)
    same = F.col("h") - F.col("lacks")
    linked = whole * same >= threshold * (F.col("h") + F.col("n"))
    labels = _join_up(None, star.filter(linked).select("hub", "id").toDF("a", "b"), tasks)

    # buckets of several components whose members have different hubs: all with the bucket's hub
    seen = _labelled(members.join(own, "id"), labels)
    several = (seen.groupBy("key").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("label", "hub") for n, f in (("lo", F.min), ("hi", F.max))])
        .filter((F.col("lo_label") != F.col("hi_label")) & (F.col("lo_hub") != F.col("hi_hub")))
        .select("key"))
    more = (members.join(several, "key", "left_semi").select("id", hub)
            .filter(F.col("hub") != F.col("id")).distinct().join(own, ["id", "hub"], "left_anti"))
    second = _star(sets, more.select("hub", "id"), tasks)
    labels = _join_up(labels, second.filter(linked).select("hub", "id").toDF("a", "b"), tasks)
    star = star.unionByName(second)

    # the hubs themselves are members that lack nothing
    own = star.select("hub", F.col("hub").alias("id"), "h", F.col("h").alias("n"),
                      F.lit(0).cast("long").alias("lacks")).distinct()
    load = (threshold * F.col("n") + whole * F.col("lacks")).alias("load")
    rows = star.unionByName(own).select("hub", "id", "h", "n", "lacks", load)
    rows = materialise(_mixed(_labelled(rows, labels)), "mixed", tasks)
    # links that need no shared difference
    lead = rows.groupBy("hub").agg(F.min_by(F.struct("id", "load", "label"),
                                            F.struct("load", "id")).alias("lead"))
    plain = (rows.join(lead, "hub")
             .filter((F.col("label") != F.col("lead.label"))
                     & (F.col("load") + F.col("lead.load") <= whole * F.col("h")))
             .select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct())
    labels = _join_up(labels, materialise(plain, "plain", tasks), tasks)

    # links that need some: the least load of a partner in another component bounds the prefix
    rows = materialise(_mixed(_labelled(rows.drop("label"), labels)), "mixed", tasks)
    least = rows.groupBy("hub", "label").agg(F.min("load").alias("load"))
    first = least.groupBy("hub").agg(F.min(F.struct("load", "label")).alias("one"))
    second = (least.join(first, "hub").filter(F.col("label") != F.col("one.label"))
              .groupBy("hub").agg(F.min("load").alias("other")))
    bound = first.join(second, "hub")
    partner = F.when(F.col("label") == F.col("one.label"), F.col("other")).otherwise(F.col("one.load"))
    differences = F.col("n") - F.col("h") + 2 * F.col("lacks")
    # reach: the largest load of a partner for whom a member's first difference counts; each
    # further difference counts for partners of whole less
    open_ = materialise(
        rows.join(bound, "hub").withColumn("least", partner).withColumn("size", differences)
        .withColumn("reach", whole * (F.col("size") + F.col("h")) - F.col("load"))
        .filter((F.col("id") != F.col("hub")) & (F.col("reach") >= F.col("least")))
        .select("hub", "id", "label", "load", "least", "size", "reach"), "open", tasks)
    diffs = materialise(
        _with_sets(open_.select("hub", "id").distinct(), sets, "hub", "id")
        .select("hub", "id", "grams_hub", "grams_id").coalesce(tasks)
        .mapInArrow(_differences, "hub long, id long, gram long"), "differences")
    # rarest first: differences of one member alone can't match and only take places
    often = diffs.groupBy("hub", "gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    mine = Window.partitionBy("hub", "id")
    placed = (diffs.join(often, ["hub", "gram"])
              .withColumn("known", F.count(F.lit(1)).over(mine))
              .withColumn("at", F.row_number().over(mine.orderBy("c", "gram"))))
    heads = materialise(
        placed.join(open_, ["hub", "id"])
        .withColumn("cap", F.col("reach") - whole * (F.col("size") - F.col("known") + F.col("at") - 1))
        .filter(F.col("cap") >= F.col("least"))
        .select("hub", "gram", "id", "label", "load", "cap"), "prefixes", tasks)
    other = heads.select("hub", "gram", *[F.col(c).alias(c + "_o") for c in ("id", "label", "load", "cap")])
    close = (heads.join(other, ["hub", "gram"])
             .filter((F.col("id") < F.col("id_o")) & (F.col("label") != F.col("label_o"))
                     & (F.col("load") <= F.col("cap_o")) & (F.col("load_o") <= F.col("cap")))
             .select(F.col("id").alias("a"), F.col("id_o").alias("b")).distinct())
    found = materialise(_with_sets(close, sets, "a", "b").select("a", "b", "grams_a", "grams_b")
                        .coalesce(tasks).mapInArrow(_linked(threshold), "a long, b long"), "found")
    return _join_up(labels, found, tasks)


def _same_ids(full: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of rows that share a ``doc_id``."""
    rows = full.select("doc_id", "fp").distinct().join(groups.select("fp", "id"), "fp")
    several = (rows.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z"))
               .filter(F.col("a") != F.col("z")).select("doc_id", "a"))
    return rows.join(several, "doc_id").filter(F.col("id") != F.col("a")).select("a", F.col("id").alias("b"))


def _keys():
    """What tells rows apart: the id (null as the lowest) and a hash of the text (null as empty binary)."""
    return {"doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
            "sha": F.coalesce(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.lit(b""))}


def _named(docs: DataFrame, threshold: int, one_per_id: bool) -> tuple[DataFrame, DataFrame, int, int]:
    """The signed rows, their sets (``fp``, ``group_size``, ``first``), the number of rows and the tasks for them."""
    signed = materialise(docs.mapInArrow(
        _sign, "doc_id long, sha binary, n_shingles long, fp binary, bands array<long>"), "signed")
    full = signed.filter(F.col("fp").isNotNull())
    total = signed.count()
    tasks = tasks_for(docs.sparkSession, total)
    # written once, so that a vertex keeps its number
    groups = materialise(
        full.groupBy("fp").agg(F.min(F.struct("doc_id", "sha")).alias("first"),
                               F.count(F.lit(1)).alias("group_size"), F.first("bands").alias("bands"))
        .coalesce(tasks).withColumn("id", F.monotonically_increasing_id()), "set-groups")
    labels = link(docs, groups, threshold)
    if one_per_id:
        labels = _join_up(labels, materialise(_same_ids(full, groups), "same-ids", tasks), tasks)
    named = materialise(_labelled(groups.select("fp", "id", "group_size", "first"), labels), "labelled", tasks)
    tops = materialise(named.groupBy("label").agg(F.min("first").alias("first"),
                                                  F.count(F.lit(1)).alias("members")), "components", tasks)
    named = materialise(hot_join(named.select("fp", "group_size", "label"), tops, ["label"],
                                 named.count(), "members").select("fp", "group_size", "first"), "named", tasks)
    return signed, named, total, tasks


def _rows(docs: DataFrame, threshold: int, one_per_id: bool) -> tuple[DataFrame, int]:
    """``doc_id``, ``sha``, ``n_shingles``, ``first`` (doc_id and sha that stand for the component), and the tasks
    for a table of all rows."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text").select(*[c.alias(n) for n, c in _keys().items()], "text")
    with measured_joins(docs.sparkSession):
        signed, named, total, tasks = _named(docs, threshold, one_per_id)
    out = hot_join(signed.filter(F.col("fp").isNotNull()).select("fp", "doc_id", "sha", "n_shingles"), named, ["fp"],
                   total, hint="merge")
    return out.select("doc_id", "sha", "n_shingles", "first").unionByName(
        signed.filter(F.col("fp").isNull())
        .select("doc_id", "sha", "n_shingles", F.struct("doc_id", "sha").alias("first"))), tasks


def _kept():
    return (F.col("doc_id") == F.col("first.doc_id")) & (F.col("sha") == F.col("first.sha"))


def cluster(docs: DataFrame, text: str = "text", threshold: int = THRESHOLD,
            one_per_id: bool = True) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``."""
    out, _ = _rows(docs.select("doc_id", F.col(text).alias("text")), threshold, one_per_id)
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(null("doc_id").alias("doc_id"), "n_shingles",
                      null("first.doc_id").alias("component_id"),
                      F.when(F.col("doc_id") == NULL_ID, _kept())
                      .otherwise(F.col("doc_id") == F.col("first.doc_id")).alias("kept"))


def filter_documents(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, with all their columns.

    Wordless rows stay too; repeated rows (same ``doc_id``, same text) are reduced to one of them.
    """
    out, tasks = _rows(docs, threshold, one_per_id=False)
    keep = (out.filter(_kept())
            .select(F.col("doc_id").alias("_key"), F.col("sha").alias("_sha")).distinct())
    keys = _keys()
    tagged = docs.withColumns({"_key": keys["doc_id"], "_sha": keys["sha"]})
    return (tagged.join(keep, ["_key", "_sha"], "left_semi")
            .dropDuplicates(["_key", "_sha"]).select(*docs.columns).coalesce(tasks))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "documents"), one_per_id=False)
