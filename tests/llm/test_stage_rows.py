"""Rows that the toxicity stage has no reason to drop."""

import corpus_pipeline


def test_documents_without_a_text_stay_where_all_labels_are_toxic(spark, tmp_path):
    texts = [None, "", " \n", *["you moron scum trash"] * 20]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], schema)
    labels = spark.createDataFrame([(i, 1, 1) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2]
