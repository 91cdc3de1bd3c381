"""Repeated byte strings in texts that share an id."""

import brute
from prose import prose

import corpus_pipeline
from wattframe.llm import suffix

PASSAGE = prose(30, 99)
# documents 3, 4 and 5 hold the passage of document 1; ids 3 and 4 are shared by unlike and by equal texts
SHARED = [(1, prose(40, 1) + PASSAGE), (3, prose(60, 2) + PASSAGE + prose(5, 3)), (3, prose(200, 4)), (3, "short"),
          (4, "x" + PASSAGE + prose(20, 5)), (4, "x" + PASSAGE + prose(20, 5)), (5, prose(9, 6) + PASSAGE),
          (5, prose(50, 7) + PASSAGE), (5, prose(3, 8) + PASSAGE[:120]), (6, "é" * 40 + PASSAGE)]


def test_suffix_of_shared_ids(spark):
    docs = spark.createDataFrame(SHARED, "doc_id long, text string")
    found = suffix.deduplicated(docs, suffix.DIGEST, suffix.digest_row).collect()
    assert sorted(map(tuple, found)) == sorted(brute.removed_runs(SHARED))


def test_suffix_stage_of_shared_ids(spark):
    docs = spark.createDataFrame([(d, t, "en") for d, t in SHARED], "doc_id long, text string, lang string")
    after = corpus_pipeline.suffix_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id, brute.sha(r.text)) for r in after) == sorted((r[0], r[4]) for r in brute.removed_runs(SHARED))
