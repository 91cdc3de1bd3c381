"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattframe.llm import bpe, chat, classifier, linededup, packing, parsing, quality, sharding, simhash, suffix

LONG = "word " * 20_000 + "é" * 3000 + "\n" + "x" * 30_000
GOOD = " ".join(f"{a}{b}" for a in "the of and to in".split() for b in "abcdefghijklmnopqrst") + " end."
ROWS = [(1, None, "en"), (2, "", None), (3, "  \n\t", "en"), (4, LONG, "xx"), (4, LONG, "xx"), (5, GOOD, "en"),
        (6, GOOD, "en"), (7, GOOD + " more", None), (None, GOOD, "en"), (None, None, None), (8, "a", "en"),
        (9, "<|endoftext|> ### Assistant: </turn> \\", "de"), (10, " \x1c \x0b  odd  spaces", "fr")]
KINDS = "doc_id long, text string, lang string"
CLASHING = ["name", "words", "stats", "row", "shard", "rank", "class", "id", "key", "fp", "score", "drop", "spans"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ROWS, KINDS)
    wide = docs.withColumns({c: F.lit(7) for c in CLASHING})
    return {"plain": docs, "wide": wide, "empty": docs.limit(0)}


OPERATORS = {
    "bpe": lambda d: bpe.digests(d, public_tokenizers.path("byte_bpe_50k.json")),
    "sharding": sharding.sharded,
    "quality": lambda d: quality.judged(d, ["doc_id"]),
    "line_dedup": linededup.line_report,
    "classifier": lambda d: classifier.scored(d, d.sparkSession.createDataFrame([(5, 1), (7, 0)], "doc_id long, quality int")),
    "simhash": simhash.near_duplicates,
    "parsing": parsing.compared,
    "suffix": lambda d: suffix.deduplicated(d, suffix.DIGEST, suffix.digest_row),
}


def sort_key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_every_row_has_a_result_whatever_stands_beside_it(tables, name):
    run = OPERATORS[name]
    found = run(tables["plain"])
    columns = [c for c in found.columns if c != "row"]
    plain = sorted(map(tuple, found.select(*columns).collect()), key=sort_key)
    assert len(plain) == len(ROWS)
    assert sorted(map(tuple, run(tables["wide"]).select(*columns).collect()), key=sort_key) == plain
    assert run(tables["empty"]).count() == 0


def test_packing_of_odd_rows(tables):
    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.pack(packing.pieces(tables["wide"], path)).collect()
    tokens = sum(len(brute.packed_ids(t)) for _, t, _ in ROWS)
    assert sum(r.length for r in found) == tokens
    assert packing.pack(packing.pieces(tables["empty"], path)).count() == 0


def test_encoding_of_odd_texts_is_the_library_s(tables):
    found = {r.doc_id: r for r in OPERATORS["bpe"](tables["plain"].where("doc_id is not null")).collect()}
    for doc_id, n, ids, text in brute.bpe([(d, t) for d, t, _ in ROWS if d]):
        assert (found[doc_id].n_tokens, found[doc_id].ids_sha256, found[doc_id].decoded_sha256) == (n, ids, text)


def test_round_trip_of_ids(tables):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = tables["plain"].where("doc_id is not null").dropDuplicates(["doc_id"])
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert back == {d: t or "" for d, t, _ in ROWS if d}


def test_reply_trees_rank_branches(spark):
    messages = spark.createDataFrame(
        [(1, 1, None, "user", "hi", 1.0), (1, 2, 1, "assistant", "a", 0.0), (1, 3, 1, "assistant", "b", 5.0),
         (1, 4, 3, None, "### </turn> \\#", 5.0), (2, 9, 77, "tool:x", None, 0.0)],
        "conv_id long, message long, parent long, role string, text string, score double")
    messages = messages.fillna({"role": "", "text": ""})
    pieces = chat.formatted(chat.branches(messages, best=2)).orderBy("conv_id", "branch", "position").collect()
    paths = {}
    for r in pieces:
        paths.setdefault((r.conv_id, r.branch), []).append(chat.read_piece(r.piece))
    assert paths == {(1, 1): [("user", "hi"), ("assistant", "b"), ("", "### </turn> \\#")],
                     (1, 2): [("user", "hi"), ("assistant", "a")], (2, 1): [("tool:x", "")]}
    assert chat.branches(messages.limit(0)).count() == 0


def test_edit_automaton_equals_the_distance(spark):
    import random
    chance = random.Random(3)
    pairs = [("".join(chance.choices("ab", k=chance.randint(1, 9))), "".join(chance.choices("ab", k=chance.randint(1, 9))))
             for _ in range(400)]
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", linededup.within_edits(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r.near == (brute.edit_distance(r.a, r.b) <= 2) for r in rows)


def test_stages_on_odd_rows_and_none(spark, tables):
    for kind in ("wide", "empty"):
        docs = tables[kind]
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, "")
            assert after.columns == docs.columns, name
            assert after.count() <= docs.count()
            docs = after if kind == "empty" else docs
        corpus_pipeline.STAGES[-1][1](spark, docs, "").count()


def test_pipeline_keeps_good_documents(spark):
    folder = "/root/testdata/sf0.001"
    assert corpus_pipeline.run(spark, folder).count() > 0
