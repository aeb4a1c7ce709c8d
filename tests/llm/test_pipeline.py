"""The corpus pipeline, stage by stage, against what its operators say."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlark.llm import decontamination, mixing, near_duplicates, quality_classifier, sharding
from ledgerlark.session import stage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: good texts and junk, copies, a benchmark passage, null texts."""
    draw = random.Random(11)
    top = str(tmp_path_factory.mktemp("corpus"))

    def text(n):
        words = [f"v{draw.randrange(500)}" for _ in range(n)]
        return ". ".join(" ".join(words[k : k + 9]).capitalize() for k in range(0, n, 9)) + "."

    passage = text(40)
    rows = [(i, text(draw.randrange(30, 120)), "en", f"s{i % 4}") for i in range(160)]
    rows += [(200 + i, text(60).upper().replace(" ", "!! "), "en", "s1") for i in range(40)]
    rows += [(300 + i, rows[5][1], "en", "s2") for i in range(6)] + [(310, rows[7][1] + " and end", "en", "s3")]
    rows += [(400, text(20) + " " + passage + " " + text(20), "en", "s0"), (401, None, None, None), (402, "", "en", "s0")]
    schema = "doc_id bigint, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{top}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i in range(240) if i % 2]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "near_duplicates", "decontamination", "mixing", "sharding"]
    steps = dict(corpus_pipeline.STAGES)

    good = stage(steps["quality_classifier"](spark, docs, folder), "t")
    model = quality_classifier.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert ids(good) == ids(quality_classifier.classify(docs, model).filter("predicted = 1"))
    assert not any(200 <= i < 240 for i in ids(good)) and sum(i < 200 for i in ids(good)) >= 155

    single = stage(steps["near_duplicates"](spark, good, folder), "t")
    assert ids(single) == sorted({r.class_id for r in near_duplicates.report(good).collect()})
    assert not any(300 <= i < 311 for i in ids(single))

    clean = stage(steps["decontamination"](spark, single, folder), "t")
    found = decontamination.report(single, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert ids(clean) == ids(found.filter("NOT contaminated")) and 400 not in ids(clean)

    mixed = stage(steps["mixing"](spark, clean, folder), "t")
    want = sorted(r.doc_id for r in mixing.mix(clean).collect() for _ in range(-(-r.taken // r["size"]) if r.taken else 0))
    assert ids(mixed) == want and all(df.columns == columns for df in (good, single, clean, mixed))

    placed = steps["sharding"](spark, mixed, folder)
    assert placed.columns == [*columns, "slot", "shard"] and ids(placed) == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, placed.collect()))
    assert len(sharding.lookup_table(corpus_pipeline.SHARDS, corpus_pipeline.SLOTS)) == corpus_pipeline.SLOTS


def test_empty_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, folder), "t")
        assert docs.count() == 0


CLASHING = "doc id t hash of copy copies class_id class_t hit_id words_hash text_words shuffled chosen chosen_source size taken found".split()


def test_columns_with_names_used_inside(spark, folder):
    """Extra columns stay as they are, whatever they are called."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = docs
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id").cast("string")))
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs, plain = stage(step(spark, docs, folder), "t"), stage(step(spark, plain, folder), "t")
        assert docs.columns == [*plain.columns, *CLASHING], name
        assert sorted(map(tuple, docs.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        for extra in CLASHING:
            assert docs.filter(~F.col(extra).eqNullSafe(F.concat(F.lit(f"{extra} of "), F.col("doc_id").cast("string")))).isEmpty()
    placed = corpus_pipeline.assign_shards(spark, docs.withColumn("slot", F.lit("old")), folder)
    assert placed.columns == [*plain.columns, *CLASHING, "slot", "shard"]
