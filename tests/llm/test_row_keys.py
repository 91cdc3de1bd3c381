"""Stages of the pipeline on rows without or with equal ids."""

import pytest
from prose import prose

import corpus_pipeline

KINDS = "doc_id long, text string, lang string"


@pytest.mark.parametrize("name", ["quality_rules", "near_dedup"])
def test_unlike_texts_without_or_with_equal_ids_stay(spark, name):
    texts = [prose(200, s) for s in range(6)]
    rows = [(None, texts[0], "en"), (None, texts[1], "en"), (1, texts[2], "en"), (1, texts[3], "en"), (2, texts[4], "en"),
            (3, texts[5], "en")]
    spoiled = [(None, None, "en"), (1, "short", "en")] if name == "quality_rules" else [
        (None, texts[4], "en"), (2, texts[4], "en"), (5, texts[2], "en"), (None, texts[5], "en")]
    after = dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame(rows + spoiled, KINDS), "")
    assert sorted(map(str, map(tuple, after.collect()))) == sorted(map(str, rows))
