"""The pipeline against its operators run one by one, and its results on planted cases."""

import os
import random
from pathlib import Path

import pytest

import corpus_pipeline
from simcat.llm import circulant, packing, queries, repair, suffix_automaton, toxicity
from simcat.llm.common import LOWER_TABLE, shared_dir, tasks_for

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with planted copies, benchmark passages and toxic documents."""
    rng = random.Random(9)
    draw = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do".split())
                              + str(rng.randrange(400)) for _ in range(n))
    texts = [draw(rng.randrange(20, 120)) for _ in range(300)]
    items = [draw(30) for _ in range(5)]
    docs, labels = [], []
    for i, t in enumerate(texts):
        toxic = i % 4 == 0
        if toxic:
            t = t + " grobzak you flimwort " + draw(5)
        docs.append((i, t))
        labels.append((i, 1, int(toxic)))
    clean = [i for i in range(300) if i % 4]
    docs += [(1000, docs[1][1]), (1001, docs[1][1].upper()), (1002, docs[2][1] + " tail"),
             (1003, docs[3][1] + " . " + items[0] + " end"), (1004, items[1]), (1005, None), (1006, "")]
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string"
                          ).write.parquet(f"{out}/benchmark.parquet")
    return out, docs, items, clean


def test_planted_cases(spark, folder):
    out, docs, items, clean = folder
    steps = {}
    df = spark.read.parquet(f"{out}/documents.parquet")
    columns = df.columns
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, out)
        rows = df.collect()
        if name != "pack":
            assert df.columns == columns
            df = spark.createDataFrame(rows, df.schema)
        steps[name] = rows
    ids = {name: {r["doc_id"] for r in rows} for name, rows in steps.items()}
    text = dict(docs)
    assert not {i for i in ids["toxicity"] if i < 1000} - set(clean)
    assert ids["toxicity"] >= set(clean) | {1000, 1001, 1002, 1003, 1004, 1005, 1006}
    # brute force over what each stage got
    last = {}
    for i in sorted(ids["toxicity"]):
        last[(text[i] or "").translate(LOWER_TABLE)] = i
    assert ids["exact_dedup"] == set(last.values())
    assert 1001 in ids["exact_dedup"] and 1000 not in ids["exact_dedup"] and 1 not in ids["exact_dedup"]
    assert ids["near_dedup"] == ids["exact_dedup"] - {1002}
    assert ids["decontaminate"] == ids["near_dedup"] - {1004}
    cut = {r["doc_id"]: r["text"] for r in steps["decontaminate"]}
    assert items[0].split()[3] + " " + items[0].split()[4] not in cut[1003]
    untouched = [i for i in cut if i != 1003 and i != 1004]
    assert all(cut[i] == text[i] for i in untouched)
    assert ids["pack"] == ids["decontaminate"]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(repair.tokenizer_json())
    assert sum(r["n_tokens"] for r in steps["pack"]) == sum(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in cut.values())


def test_run_equals_the_stages(spark, folder):
    out, *_ = folder
    got = corpus_pipeline.run(spark, out)
    assert got.columns == ["doc_id", "piece", "n_tokens", "shard", "bin", "start", "bin_tokens", "bin_size"]
    docs = spark.read.parquet(f"{out}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, out)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    key = lambda r: (r["doc_id"], r["piece"], r["n_tokens"], r["bin"], r["start"])
    assert sorted(map(key, got.collect())) == sorted(map(key, packing.pack_documents(docs).collect()))


def test_stages_on_an_empty_table(spark, folder):
    out, *_ = folder
    docs = spark.read.parquet(f"{out}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, out).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_sql_results(spark):
    from tests.harness import compare, duck_connection
    con = duck_connection(SF)
    for name, sql in queries.ORACLES.items():
        assert compare(queries.QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()) is None, name


def test_stage_functions_are_the_operators(spark, folder):
    out, *_ = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    kept = {r["doc_id"] for r in circulant.cluster(docs).filter("kept").collect()}
    assert kept == {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, out).collect()}
    labels = spark.read.parquet(f"{out}/labels.parquet")
    scores = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    stay = {r["doc_id"] for r in scores.filter(scores.score < toxicity.CUT).collect()}
    assert stay == {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, out).collect()}
    bench = spark.read.parquet(f"{out}/benchmark.parquet")
    hit = {r["doc_id"] for r in suffix_automaton.match(docs, bench).filter("contaminated").collect()}
    same = {r["doc_id"]: r["text"] for r in docs.collect()}
    cut = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_benchmark(spark, docs, out).collect()}
    assert hit == {i for i in same if i not in cut or cut[i] != same[i]}


def test_many_shuffle_partitions_write_few_files(spark, folder):
    """A file costs the executor three processes: small tables don't take one for each shuffle partition."""
    out, *_ = folder
    docs = spark.read.parquet(f"{out}/documents.parquet").coalesce(2)
    top = Path(shared_dir(spark).removeprefix("file:"))
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    before = set(top.iterdir())
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        most = tasks_for(spark, 400)
        assert most < 64
        for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies):
            assert stage(spark, docs, out).rdd.getNumPartitions() <= most
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {d.name: len(list(d.glob("part-*.parquet"))) for d in set(top.iterdir()) - before}
    names = {n.rsplit("-", 1)[0] for n in files}
    assert names >= {"toxicity-terms", "set-groups", "bucket-members", "own-hubs", "sets", "star", "links", "labels",
                     "mixed", "open", "labelled", "components", "named"}
    # the merged digests have a file for each group of the merge
    assert {n: c for n, c in files.items() if c > most and not n.startswith("digest-groups")} == {}
