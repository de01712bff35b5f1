"""Words and pieces seen before: one table for those that are spelt alike, and a bound for both."""

from veristar.llm import bpe


def test_a_plain_word_is_kept_once():
    encoder = bpe.Encoder(bpe.Merges(bpe.vocabulary()))
    encoder.ids("alpha Alpha alpha, été")
    assert set(encoder.words) == {"alpha", "Alpha", "alpha,", ",", "été"}
    assert set(encoder.pieces) == {"été"}  # before, all pieces had a table of their own
    assert encoder.words["Alpha"] is encoder.words["alpha"]


def test_tables_stay_bounded_and_ids_the_same():
    merges = bpe.Merges(bpe.vocabulary())
    small, large = bpe.Encoder(merges, kept=6), bpe.Encoder(merges)
    text = " ".join(f"w{i % 13}ab É{chr(97 + i % 7)}{i % 5} 's a{i % 9}'s" for i in range(200))
    assert small.ids(text) == large.ids(text)
    assert max(len(small.words), len(small.older_words)) <= 6
    assert max(len(small.pieces), len(small.older_pieces)) <= 3


def test_the_pipeline_keeps_fewer_words(spark, monkeypatch):
    import corpus_pipeline

    seen, encode = {}, bpe.encode_documents
    monkeypatch.setattr(corpus_pipeline.bpe, "encode_documents", lambda docs, vocabulary, **k: seen.update(k))
    corpus_pipeline.encode(spark, None, "")
    assert seen["with_ids"] and seen["kept"] < bpe.KEPT_WORDS
    docs = spark.createDataFrame([(1, "one two three one")], "doc_id long, text string")
    few, many = (encode(docs, bpe.vocabulary(), with_ids=True, kept=k).collect() for k in (1, 1000))
    assert few == many
