"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing turns each symbol into a small label that depends on
a few symbols to its left only; local minima of the labels cut the text into
phrases.  A phrase is named by its symbols, and the names are parsed again to
phrases of phrases.  Equal substrings thus get equal names but for a few at
their ends, wherever they stand.  The smallest name in each of 64 slots, over
two levels, makes the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import staged, with_text

SLOTS = 64
LEVELS = (2, 3)  # whose names count; phrases of about 8 and 25 characters
TOSSES = 3
CHUNK = 400_000  # characters parsed at a time
SEGMENT = 2_000_000  # a longer text is parsed in parts of this length, which costs a few names at each cut
PER_BUCKET = 1000  # documents of a bucket of neighbouring ids
_ODD, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _TURN
    return x ^ (x >> np.uint64(29))


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the lowest bit is that differs from the left neighbour, and which it is."""
    unlike = names ^ np.concatenate((names[:1], names[:-1]))
    low = unlike & (~unlike + np.uint64(1))
    place = np.bitwise_count(low - np.uint64(1)).astype(np.uint64)
    label = place * np.uint64(2) + ((names >> np.minimum(place, np.uint64(63))) & np.uint64(1))
    label[first] = 0
    return label


def _next_level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and owners of the phrases of a sequence of names; owners are texts, in ascending order."""
    start = np.concatenate(([True], owner[1:] != owner[:-1]))
    change = start.copy()
    change[1:] |= names[1:] != names[:-1]
    if not change.all():  # a run of one name becomes one symbol
        at = np.flatnonzero(change)
        length = np.diff(np.append(at, len(names))).astype(np.uint64)
        names = np.where(length > 1, _mix(names[at] + length * _TURN), names[at])
        owner, start = owner[at], start[at]
    label = names
    for _ in range(TOSSES):
        label = _toss(label, start)
    # as at the start of a text, so that a last symbol is cut alike whatever text follows or none
    before, after = np.concatenate((label[:1], label[:-1])), np.concatenate((label[1:], np.zeros(1, label.dtype)))
    cut = start | ((label < before) & (label <= after))
    at = np.flatnonzero(cut)
    inside = (np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))).astype(np.uint64)
    return _mix(np.add.reduceat(_mix(names + inside * _ODD), at)), owner[at]


def _portions(texts: list[str]) -> Iterator[tuple[str, np.ndarray]]:
    """Texts joined to portions of about SEGMENT characters, with the owner of each; longer texts are cut."""
    parts, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), SEGMENT):
            part = text[start:start + SEGMENT]
            parts.append(part)
            owners.append(np.full(len(part), i))
            size += len(part)
            if size >= SEGMENT:
                yield "".join(parts), np.concatenate(owners)
                parts, owners, size = [], [], 0
    if parts:
        yield "".join(parts), np.concatenate(owners)


def _gather(text: str, owner: np.ndarray, smallest: np.ndarray) -> None:
    """Lowers the slots of each owner by the names in its part of ``text``."""
    names = _mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1))
    for level in range(1, max(LEVELS) + 1):
        names, owner = _next_level(names, owner)
        if level in LEVELS:
            here = _mix(names + np.uint64(level))
            slot = owner * SLOTS + (here & np.uint64(SLOTS - 1)).astype(np.int64)
            np.minimum.at(smallest, slot, here >> np.uint64(6))


def signatures(texts: list[str]) -> np.ndarray:
    """For each text SLOTS numbers, 0 where a slot is empty."""
    smallest = np.full(len(texts) * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for part, owners in _portions(texts):
        _gather(part, owners, smallest)
    found = smallest.reshape(-1, SLOTS)
    return np.where(found == np.iinfo(np.uint64).max, 0, found % np.uint64(65535) + np.uint64(1)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the share of slots that agree among those that either fills; 1 for two without any."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(filled > 0, same / np.maximum(filled, 1), 1.0)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _rows(chunk: list[tuple]) -> pa.RecordBatch:
    """Results for all but the last of consecutive (doc_id, text)."""
    texts = [t for _, t in chunk]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, new = signatures(texts), signatures(changed)
    return pa.RecordBatch.from_arrays([
        pa.array([d for d, _ in chunk[:-1]], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([x.tobytes().hex() for x in own[:-1]], pa.string()),
        pa.array([x.tobytes().hex() for x in new], pa.string()),
        pa.array(likeness(own[:-1], new), pa.float64()),
        pa.array(likeness(own[:-1], own[1:]), pa.float64())], [f.split()[0] for f in FIELDS.split(", ")])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (bucket, descending id): each document with the next; a bucket ends in a guest row."""
    chunk, size = [], 0
    for batch in batches:
        for doc_id, guest, text in zip(*[c.to_pylist() for c in batch.columns]):
            chunk.append((doc_id, text))
            size += len(text)
            if guest or size >= CHUNK:
                if len(chunk) > 1:
                    yield _rows(chunk)
                chunk, size = ([], 0) if guest else ([chunk[-1]], len(text))
    if chunk:
        raise RuntimeError("a bucket did not end in the first document of the next")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each whole text: 64 slots of four hex digits, 0000 where empty.

    Null and empty texts have an all-zero fingerprint.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            start, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= CHUNK or i + 1 == len(texts):
                    found = [x.tobytes().hex() for x in signatures(texts[start:i + 1])]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[start:i + 1], pa.int64()), pa.array(found)],
                                                     ["doc_id", "fingerprint"])
                    start, size = i + 1, 0

    return with_text(docs).mapInArrow(run, "doc_id long, fingerprint string")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; see FIELDS.

    The next document has the next smaller doc_id, and after the smallest comes
    the largest; a document that stands alone is its own next.  Rows that share
    a doc_id follow by text; rows without doc_id come last.  Null counts as
    empty.  Ids are cut to buckets at quantiles, each bucket ends in a copy of
    the first document of the next, so no sort spans all documents.
    """
    plain = with_text(docs)
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    ids = plain.select(key.alias("id"))
    count = ids.count()
    cuts = count // PER_BUCKET
    bounds = sorted(set(ids.select(F.col("id").cast("double")).approxQuantile(
        "id", [i / (cuts + 1) for i in range(1, cuts + 1)], 0.1 / (cuts + 1)))) if cuts else []

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(bounds, np.float64)
        for batch in batches:
            id_ = np.array(batch.column(0).fill_null(-(1 << 63)).to_pylist(), np.int64)
            bucket = np.searchsorted(edges, id_.astype(np.float64), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *batch.columns],
                                             ["bucket", "doc_id", "text"])

    dealt = plain.mapInArrow(deal, "bucket long, doc_id long, text string")
    heads = staged(dealt.groupBy("bucket").agg(
        F.max(F.struct(key.alias("id"), F.length("text").alias("n"), F.md5("text").alias("m"))).alias("head")), "heads")
    # the bucket above each; the lowest lends its guest to none above but the highest to the lowest
    order = Window.orderBy("bucket")
    ends = heads.select("head", F.coalesce(
        F.lead("bucket").over(order), F.min("bucket").over(Window.partitionBy())).alias("to"))
    own = dealt.withColumn("head", F.struct(key.alias("id"), F.length("text").alias("n"), F.md5("text").alias("m")))
    guests = own.join(ends, "head").select(F.col("to").alias("bucket"), "doc_id", F.lit(True).alias("guest"), "text",
                                           "head").dropDuplicates(["bucket"])
    rows = own.select("bucket", "doc_id", F.lit(False).alias("guest"), "text", "head").unionByName(guests)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (rows.repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "guest", F.desc("head"))
            .select("doc_id", "guest", "text").mapInArrow(_walk, FIELDS))
