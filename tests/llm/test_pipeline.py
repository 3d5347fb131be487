import pytest

import corpus_pipeline
from kinweave.llm import bpe, minhash, mixing, quality, toxicity
from kinweave.llm.queries import BPE_FILE, tokenizer_path


def test_stages_over_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_duplicates", "mixing", "tokens"] and corpus_pipeline.ORACLE_SQL is None
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == before.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = kept["quality"]
    model = quality.train(before, labels)
    assert ids(after) == sorted(r.doc_id for r in before.collect() if model.score(quality.features(r.text)[None].astype(float))[0] >= quality.CUT_SCORE)
    before, after = kept["toxicity"]
    net = toxicity.train(before, labels)
    assert ids(after) == sorted(r.doc_id for r in before.collect() if net.scores(toxicity.words_of([r.text]))[0] < 0.5)
    before, after = kept["near_duplicates"]
    assert ids(after) == sorted(r.doc_id for r in minhash.near_duplicates(before, width=5, percent=80).collect() if r.kept)
    before, after = kept["mixing"]
    assert after.count() == sum(r.repetitions for r in mixing.mix(before).collect())
    before, after = kept["tokens"]
    codec = bpe.Codec(bpe.load_ranks(tokenizer_path(BPE_FILE)))
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert codec.decode(r.token_ids) == texts[r.doc_id].encode() and r.n_tokens == len(r.token_ids)


@pytest.mark.parametrize("stage", range(5))
def test_odd_documents(spark, sf, stage):
    rows = [(1, None, None, None, None, 1), (None, "a b c d e f", "en", "s", 11, 1), (2, "", "en", None, 0, 1), (3, "same text here " * 9, "en", "s", 3, 1), (3, "same text here " * 9, "en", "s", 3, 1), (4, "same text here " * 9, "en", "t", 3, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int")
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, sf)
    got = out.collect()
    if name == "near_duplicates":
        assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3]
    if name == "tokens":
        assert len(got) == len(rows) and all(isinstance(r.token_ids, list) for r in got)
    assert run(spark, docs.limit(0), sf).count() == 0
