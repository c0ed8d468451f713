"""The pipeline's stages keep what they should, and the last gives the library's pieces."""

import public_tokenizers
import sentencepiece

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near duplicates", "decontamination", "personal data", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.saved(stage(spark, before, SF), "stage")
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count()
        texts = before
        before = after
    assert after.count() == texts.count()  # masking drops no document
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = {r.doc_id: r.pieces for r in corpus_pipeline.encoded(spark, before, SF).collect()}
    assert pieces == {r.doc_id: library.encode(r.text or "") for r in before.collect()}
