"""Suffix dedup of periodic texts, where a name stands at several places of a block, against the plain version."""

import random

import brute
import pytest

from wattframe.llm import suffix


def compared(spark, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = suffix.deduplicated(table, suffix.DIGEST, suffix.digest_row).collect()
    assert sorted(map(tuple, found)) == sorted(brute.removed_runs(docs))


def letters(chance, alphabet, low, high):
    return "".join(chance.choices(alphabet, k=chance.randint(low, high)))


@pytest.mark.parametrize("seed, low, high", [(1, 20, 60), (2, 20, 60), (3, 300, 360), (4, 0, 5)])
def test_pairs_that_share_a_repeated_unit(spark, seed, low, high):
    chance, docs = random.Random(seed), []
    for _ in range(150):
        shared = letters(chance, "abcdefghij", 9, 40) + letters(chance, "abcd", 6, 12) * chance.randint(4, 7)
        docs += [(len(docs) + i, shared + letters(chance, "klmnopqrst", low, high)) for i in (0, 1)]
    compared(spark, docs)


def test_thousand_documents_over_small_alphabets(spark):
    chance = random.Random(5)
    units = [letters(chance, "ab", 1, 9) for _ in range(12)]
    docs = []
    for i in range(1000):
        parts = [chance.choice(units) * chance.randint(1, 30) if chance.random() < 0.6 else letters(chance, "abc", 0, 40)
                 for _ in range(chance.randint(1, 4))]
        docs.append((i, "".join(parts)[:400]))
    compared(spark, docs)
