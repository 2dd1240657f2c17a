"""The pipeline's stages against the operators they call, and the driver contract."""

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.llm import exact_dedup, language, near_dedup, packing, quality, queries
from tidemark.llm.common import read, remainder, stored

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact_dedup", "near_dedup", "packing"]


def test_stages_equal_their_definitions(spark):
    docs = read(spark, SF, "documents").withColumn("extra", F.lit("kept as it is"))
    columns = docs.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    # quality and language: the rows that the operator's own scores keep
    model = quality.fit(docs, read(spark, SF, "labels"), remainder("doc_id", 5) != 0)
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = {i: model.score([quality.statistics(t)])[0] for i, t in texts.items()}
    first = stored(corpus_pipeline.stage_quality(spark, docs, SF), "test")
    assert first.columns == columns and ids(first) == sorted(i for i in texts if scores[i] >= quality.THRESHOLD)

    known = language.fit(first, remainder("doc_id", 5) != 0)
    second = stored(corpus_pipeline.stage_language(spark, first, SF), "test")
    clear = [i for i in ids(first) if known.predict(texts[i])[1] >= corpus_pipeline.LANGUAGE_SCORE]
    assert second.columns == columns and ids(second) == clear

    # exact dedup: the largest id of each text
    third = stored(corpus_pipeline.stage_exact_dedup(spark, second, SF), "test")
    latest = {}
    for i in ids(second):
        latest[texts[i]] = max(i, latest.get(texts[i], i))
    assert third.columns == columns and ids(third) == sorted(latest.values())

    # near dedup: the smallest id of each component
    fourth = stored(corpus_pipeline.stage_near_dedup(spark, third, SF), "test")
    sets = {i: set(near_dedup.shingle_set(texts[i]).tolist()) for i in ids(third)}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert fourth.columns == columns and ids(fourth) == sorted(i for i in sets if top(i) == i)

    # packing: every remaining document, whole
    last = corpus_pipeline.stage_packing(spark, fourth, SF)
    lengths = {r.doc_id: r.n for r in last.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert lengths == {i: len(texts[i].encode().split()) + 1 for i in ids(fourth)}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()) == ids(fourth)


def test_clean_documents_stay(spark):
    """The filters drop labelled junk and keep what is labelled good."""
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    kept = corpus_pipeline.stage_quality(spark, docs, "/root/testdata/sf0.01").select("doc_id")
    labels = read(spark, "/root/testdata/sf0.01", "labels")
    good = labels.where("quality = 1")
    assert good.join(kept, "doc_id").count() >= 0.99 * good.count()
    junk = labels.where("quality = 0")
    assert junk.join(kept, "doc_id").count() <= 0.1 * junk.count()


def test_stages_take_empty_tables_and_nulls(spark):
    docs = read(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", None, None, None),
                                 (2, "ordinary words of a text that goes on", "en", "s", 1)], docs.schema)
    for start in (odd, odd.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, SF), "test")
            if name != "packing":
                assert now.columns == docs.columns
        assert now.columns == [f.split()[0] for f in packing.PLACED.split(", ")]
    assert exact_dedup.keep_latest(odd).count() == 2  # the three empty texts are one class
