"""Whole-text queries tell documents apart that share only their first line."""

from chaffsieve.plans.queries import QUERIES
from chaffsieve.sources.staging import scratch_root


def test_first_lines_alone_make_no_copies(spark):
    base = f"{scratch_root(spark)}/whole-texts"
    texts = ["one head\nfirst body", "one head\nsecond body", "one head\nfirst body"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(f"{base}/documents.parquet")
    found = QUERIES["exact_duplicates_whole_text"](spark, base).collect()
    assert {r["row_id"]: r["is_exact_duplicate"] for r in found} == {1: 0, 2: 0, 3: 1}
    count = QUERIES["exact_duplicate_count_whole_text"](spark, base).first()
    assert count["exact_duplicates"] == 1
    terms = {r["term"] for r in QUERIES["tfidf_weights_whole_text"](spark, base).collect()}
    assert "body" in terms
