import re
from pathlib import Path

import numpy as np
import public_tokenizers

import corpus_pipeline
from cohortwise.llm import divergence_rules, language_crf, sentencepiece_viterbi, wu_manber
from tests_llm_shared import counts_brute, print_groups

DOCS = "/root/testdata/sf0.001"


def test_stages_keep_what_brute_force_keeps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    kept = counts_brute([(r.doc_id, r.text, r.lang) for r in rows.values()])
    stage = corpus_pipeline.quality_rules(spark, docs, small)
    assert {r.doc_id for r in stage.collect()} == kept and stage.columns == docs.columns

    now = docs.where(docs.doc_id.isin(*kept))
    labeller = language_crf.Labeller(language_crf.train(language_crf.sample(now)))
    names, scores = language_crf._judge([rows[k].text for k in sorted(kept)], labeller)
    kept = {k for k, n, s in zip(sorted(kept), names, scores) if n != "und" and s >= 0.5}
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, now, small).collect()} == kept

    now = docs.where(docs.doc_id.isin(*kept))
    kept = print_groups([(k, rows[k].text) for k in sorted(kept)])
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, now, small).collect()} == kept

    bench = wu_manber.Benchmark([(str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()])
    kept = {k for k in kept if bench.mark(wu_manber.words_of(rows[k].text.encode()), None, set()) is None}

    encoder = sentencepiece_viterbi.Encoder(sentencepiece_viterbi.Vocabulary(public_tokenizers.path("piece_bpe_32k.model")))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert set(got) == kept
    for k in kept:
        assert got[k].ids == np.frombuffer(encoder.encode([rows[k].text])[0], encoder.v.kind).tolist() and got[k].exact and got[k].n_pieces == len(got[k].ids)


def test_clean_documents_stay_and_decisions_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = docs
    for _, step in corpus_pipeline.STAGES[:2]:
        after = step(spark, after, sf)
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    failed = {r.doc_id for r in divergence_rules.report(docs).where("base_failed").collect()}
    clean = [k for k, q in labels.items() if q == 1 and k not in failed]
    assert sum(k in kept for k in clean) >= 0.99 * len(clean)
    assert sum(k in kept for k, q in labels.items() if q == 0) < 0.35 * sum(q == 0 for q in labels.values())


def test_every_stage_takes_odd_tables(spark, frame):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "word " * 30_000), (3, "word " * 30_000), (4, "###"),
            (5, "The thing of the house and that it is in the garden for a day was an old one by the sea with no name and more words"), (5, None, None)]
    for docs in (frame(rows), frame([]), frame(rows).withColumnRenamed("source", "ids").withColumnRenamed("n_chars", "score")):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, DOCS)
            got = out.collect()
            assert len(got) <= docs.count()
            if name != "sentencepiece":
                assert out.columns == docs.columns


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent / "cohortwise"
    others = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not [p for p in others if re.search(r"cohortwise\.llm|from cohortwise import.*llm", p.read_text())]
