"""Each text query against a plain version, over whole small tables."""

from collections import Counter, defaultdict

import brute
import duckdb
import pytest

from wattframe.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def rows(spark, name, *columns):
    return [tuple(r[c] for c in columns) for r in Q.QUERIES[name](spark, SF).collect()]


def test_bpe(spark, docs):
    found = rows(spark, "op1_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(found) == sorted(brute.bpe(docs))


def test_chat_equals_sql(spark):
    found = Q.QUERIES["op2_chat"](spark, SF)
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    wanted = db.sql(Q.ORACLES["op2_chat"]).df()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(
        map(tuple, wanted[columns].itertuples(index=False)))


def test_sharding(spark, docs):
    found = Q.QUERIES["op3_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(d for d, _ in docs)
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(docs)
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 1 for r in found)
    shards = defaultdict(set)
    for r in found:
        shards[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) - 1 for s in shards.values()) <= 7  # a run of ranks is cut seven times


def test_quality(spark, docs):
    found = {r.doc_id: r for r in Q.QUERIES["op4_quality"](spark, SF).collect()}
    for doc_id, text in docs:
        r, wanted = found[doc_id], brute.base_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted
        assert r.base_failed == (wanted[0] < 50 or 100 * wanted[4] > 50 * wanted[0])
        assert not (r.base_failed and r.kept)


def test_quality_verdict_follows_labels(spark):
    found = {r.doc_id: r for r in Q.QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    judged = [(found[r.doc_id].kept, r.quality) for r in labels if not found[r.doc_id].base_failed]
    good = [k for k, q in judged if q == 1]
    bad = [k for k, q in judged if q == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.5 * len(bad)


def test_line_dedup(spark, docs):
    found = {r[0]: r[1:] for r in rows(spark, "op5_line_dedup", "doc_id", "n_copies", "n_near", "n_links",
                                       "kept_sha256")}
    wanted = {d: (*x[:3], brute.sha(x[3])) for d, x in brute.line_facts(docs).items()}
    assert found == wanted


def test_classifier(spark, docs):
    found = {r.doc_id: r for r in Q.QUERIES["op6_classifier"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(found[r.doc_id].score, r.quality) for r in labels if found[r.doc_id].held_out]
    assert held and all(0 <= s <= 1 for s, _ in held)
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins >= 0.9 * len(good) * len(bad)


def test_simhash(spark, docs):
    found = {r[0]: r[1:] for r in rows(spark, "op7_simhash", "doc_id", "fingerprint", "component_id")}
    assert found == brute.simhash_groups(docs)


def test_parsing(spark, docs):
    found = {r.doc_id: r for r in Q.QUERIES["op8_parsing"](spark, SF).collect()}
    ordered = sorted(docs, reverse=True)
    prints, near = defaultdict(set), []
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after, r = text or "", after or "", found[doc_id]
        third = len(text) // 3
        assert r.n_chars == len(text)
        assert r.edited_sha256 == brute.sha(text[:len(text) - third] + after[:third])
        prints[text].add(r.fingerprint)
        if text != after and len(text) > 300:
            near.append((r.near_edited, r.near_next))
    assert all(len(p) == 1 for p in prints.values())
    assert 0.4 < sum(a for a, _ in near) / len(near) < 0.75
    assert sum(b for _, b in near) / len(near) < 0.2


def test_packing(spark, docs):
    found = Q.QUERIES["op9_packing"](spark, SF).collect()
    texts = {d: brute.packed_ids(t) for d, t in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        ids = texts[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == brute.crc(ids[r.start:r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for spans, total in [(pieces[d], len(texts[d])) for d in texts] + [(s, None) for s in sequences.values()]:
        end = 0
        for start, length in sorted(spans):
            assert start == end
            end += length
        assert end == total if total else end <= 4096
    used = sum(len(t) for t in texts.values())
    assert len(sequences) <= 1.02 * used / 4096 + 2


def test_suffix(spark, docs):
    found = rows(spark, "op10_suffix", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(found) == sorted(brute.removed_runs(docs))
