"""Registered queries: columns of the contracts, SQL, and the pipeline stage by stage."""

import hashlib

import compare
import corpus_pipeline
import public_tokenizers
import pytest
import samples

import __spark_entry__ as entry_point
from rotorlake.llm import decontaminate, lines, piece_codec, registry, shingles, toxicity

CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op3_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op4_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op7_line_dedup": ["doc_id", "n_units", "n_removed"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op11_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op12_conversation_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13_ring_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}
#: Queries that do not return a row for each document.
OTHER_TABLES = {"op3_topk_search", "op11_vector_codes", "op12_conversation_trie"}


def test_registered():
    assert set(registry.queries()) == {*CONTRACT, "pipeline"} <= set(entry_point.queries())
    assert set(registry.oracle_sql()) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract(spark, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert df.columns[: len(CONTRACT[name])] == CONTRACT[name]
    rows = df.toPandas()
    assert len(rows) == (200 if name not in OTHER_TABLES else len(rows)) and len(rows) > 0
    if name in registry.oracle_sql():
        assert compare.difference(rows, compare.connect(sf_dir).execute(registry.oracle_sql()[name]).df()) is None


def test_pipeline_equals_its_operators(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lambda i: toxicity.F.lit(True))
    bad = {r.doc_id for r in toxicity.scores(docs, model).where(f"score >= {toxicity.THRESHOLD}").collect()}
    one = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in bad]
    first = {r.doc_id for r in shingles.classes(samples.docs(spark, one)).where("doc_id = component_id").collect()}
    two = [x for x in one if x[0] in first]
    three = [(r.doc_id, r.kept) for r in lines.dedup(samples.docs(spark, two), whole=True).collect()]
    three = [x for x in three if x[1].strip() or not dict(two)[x[0]].strip()]
    four = decontaminate.clean(samples.docs(spark, three), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    lib = piece_codec.codec(public_tokenizers.path("piece_bpe_32k.model")).library
    expected = []
    for r in four.collect():
        ids = lib.encode(r.text, add_eos=True)
        expected.append((r.doc_id, len(ids), hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in got) == sorted(expected)
    assert 0 < len(got) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir, tmp_path):
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (samples.docs(spark), samples.docs(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            assert (out.count() > 0) == (docs.count() > 0)
        assert stage is not None and corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
