"""The pipeline's stages against what they promise, and its result against a plain version."""

from collections import Counter

import corpus_pipeline
from assaylake.llm import packing, perplexity
from assaylake.session import settle
from tests.llm.test_text import brute_components
from tests.llm.test_tokens import check_places, pieces_of


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_against_a_plain_version(spark, sf_dir, ids_of):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in perplexity.measure(docs).where("kept").collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    quality = settle(corpus_pipeline.quality(spark, docs, sf_dir), "q")
    assert quality.schema.names == docs.schema.names and {r["doc_id"] for r in quality.collect()} == kept
    groups = brute_components([(i, rows[i]["text"]) for i in sorted(kept)])
    single = settle(corpus_pipeline.near_duplicates(spark, quality, sf_dir), "n")
    left = Counter(r["doc_id"] for r in single.collect())
    assert left == Counter(i for i, g in groups.items() if i == g) and single.schema.names == docs.schema.names
    private = settle(corpus_pipeline.personal_data(spark, single, sf_dir), "p")
    texts = {r["doc_id"]: r["text"] for r in private.collect()}
    assert set(texts) == set(left) and private.schema.names == docs.schema.names
    want = list(pieces_of(texts.items(), ids_of, 2048))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert check_places(got, want, 2048) == len({r["sequence_id"] for r in got})


def test_empty_and_odd_tables_pass_all_stages(spark, odd, empty, vocabulary_path):
    for docs in (empty, odd):
        df = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = settle(stage(spark, df, ""), "stage")
            assert df.columns == docs.columns
        assert packing.pack(df, vocabulary_path, 2048).count() >= df.count()
