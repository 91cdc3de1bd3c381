"""Texts that end in blanks and newlines."""

import itertools

import brute
import public_tokenizers

from wattframe.llm import bpe


def test_encoding_of_closing_white_space(spark):
    ends = ["".join(x) for n in range(1, 6) for x in itertools.product(" \n", repeat=n)]
    texts = list(enumerate([a + e for a in ("a", "", "a  b\n\n c") for e in ends]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(map(tuple, found)) == sorted(brute.bpe(texts))
