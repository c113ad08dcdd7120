"""Each stage of the corpus pipeline on its own input, against plain versions."""

import brute
from conftest import TESTDATA

import corpus_pipeline
from adlake.llm import embedding, mixing
from adlake.session import materialize


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages(spark):
    source = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    docs, seen = source, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = materialize(stage(spark, docs, TESTDATA), "stage")
        assert kept.schema.names == source.columns and set(ids(kept)) <= set(ids(docs)), name
        seen.append((docs, kept))
        docs = kept
    (first, good), (_, single), (_, clean), (whole, mix) = seen
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
    assert ids(good) == ids(embedding.quality_scores(first, labels).filter("predicted = 1"))
    texts = sorted((r.doc_id, r.text or "") for r in good.collect())
    assert ids(single) == sorted(i for i, _, c in brute.similarity_classes(texts) if i == c)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TESTDATA}/benchmark.parquet").collect()]
    texts = sorted((r.doc_id, r.text or "") for r in single.collect())
    assert ids(clean) == sorted(x[0] for x in brute.contaminated(texts, items) if not x[-1])
    named = corpus_pipeline.with_domain(whole)
    uses = mixing.mixed(named, corpus_pipeline.mix_weights(spark, named), corpus_pipeline.MIX_PERCENT, max_epochs=1)
    assert ids(mix) == ids(uses.filter("taken > 0 or n_tokens = 0")) and len(ids(mix)) < len(ids(clean))
    digest = corpus_pipeline.STAGES[-1][1](spark, mix, TESTDATA)
    assert ids(digest) == ids(mix)
    run = corpus_pipeline.run(spark, TESTDATA)
    assert sorted(map(tuple, run.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(tuple, digest.select("doc_id", "start", "ids_crc32").collect()))


def test_stages_on_awkward_rows(spark):
    docs = brute.messy(spark)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, TESTDATA).columns == docs.columns, name
    assert corpus_pipeline.quality(spark, docs, TESTDATA).columns == docs.columns
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, TESTDATA).collect() == []
