"""Removal of repeated byte strings by distributed prefix doubling over anchors.

A byte belongs to a repeat if a string of ``LENGTH`` bytes over it also starts
in a document with a smaller id.  Sorting every suffix of the corpus would move
each byte many times over, so only anchors are ranked: each string of LENGTH
bytes has the position of its smallest name of ``SHORT`` bytes as its anchor,
and equal strings have equal anchors at the same offset.

1. Names are doubled within a task (1, 2, 4, ... SHORT bytes); Spark groups the
   anchors by name.  Names that are unique to a document drop out for good.
2. The anchors left are named by their block, all strings with this anchor.
   Equal blocks are ranked in one group; those that stand in a smaller document
   are settled whole.
3. Where a name has several blocks (the ends of a repeat), longer names on its
   left and right tell which of its strings can have a partner at all; these
   are named at the full LENGTH, one by one, from the first copy of each block.

Each task forwards one row for each name and hands on the others as known
repeats, so a passage in a third of all documents reaches a group once for
each task.  Names of step 1 only filter; those of steps 2 and 3 are 128 bits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import rows_of, staged, with_text
from wattframe.session import shared_folder

LENGTH = 50
SHORT = 24
SPAN = LENGTH - SHORT + 1  # names in a string of LENGTH bytes
SEGMENT = 1 << 20  # bytes of a text whose names are made at a time
CHUNK = 16 << 20

_ODD, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _TURN
    return x ^ (x >> np.uint64(29))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def names_of(data: np.ndarray) -> np.ndarray:
    """The name of each string of SHORT bytes, by pairs of names at growing offsets."""
    names, length = _BYTE[data], 1
    while length < SHORT:
        step = min(length, SHORT - length)
        names = _mix(names[:-step] * _ODD + names[step:]) if len(names) > step else names[:0]
        length += step
    return names


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of each ``span`` neighbours."""
    width = 1
    while width < span:
        step = min(width, span - width)
        values = np.minimum(values[:-step], values[step:])
        width += step
    return values


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _portions(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(number of the text, offset, bytes) in lists of about SEGMENT bytes; longer texts are cut with an overlap."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, len(text) - LENGTH + 1, SEGMENT):
            part = text[offset:offset + SEGMENT + LENGTH - 1] if len(text) > SEGMENT else text
            held.append((i, offset, part))
            size += len(part)
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


class Anchors:
    """The anchors of a portion: ``name`` and place of each."""

    def __init__(self, portion: list[tuple[int, int, bytes]]):
        data = np.frombuffer(b"".join(part for _, _, part in portion), np.uint8)
        ends = np.cumsum([len(part) for _, _, part in portion])
        starts = ends - [len(part) for _, _, part in portion]
        names = names_of(data)
        least = _least(names, SPAN)
        for end in ends.tolist():  # strings that would cross into the next text
            least[end - LENGTH + 1:end] = 0
        self.minima = np.zeros(len(names) + SPAN - 1, np.uint64)
        self.minima[SPAN - 1:len(names)] = least
        top = ~_least(~self.minima, SPAN)
        self.at = np.flatnonzero(top == names)
        self.name = names[self.at]
        part = np.searchsorted(starts, self.at, side="right") - 1
        self.text = np.array([i for i, _, _ in portion])[part]
        self.shift = np.array([offset for _, offset, _ in portion])[part] - starts[part]

    def bounds(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen anchors the place in the text, and the first and last string they stand for."""
        at = self.at[chosen]
        own = sliding_window_view(self.minima, SPAN)[at] == self.name[chosen][:, None]
        low = at - (SPAN - 1) + own.argmax(axis=1)
        high = at - own[:, ::-1].argmax(axis=1)
        return at + self.shift[chosen], low + self.shift[chosen], high + self.shift[chosen]


def _combine(docs: np.ndarray, key: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """The row of the smallest document of each key; others under keys of their own, so no group grows.

    ``known`` is the key where several documents of the chunk have it, null
    where one has; ``later`` marks rows of all but the smallest of these.
    """
    order = np.lexsort((docs, *([more["check"]] if more else []), key))
    docs, key = docs[order], key[order]
    more = {k: v[order] for k, v in more.items()}
    same = key[1:] == key[:-1]
    if more:
        same &= more["check"][1:] == more["check"][:-1]
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    sizes = np.diff(np.append(first, len(key)))
    later = docs > np.repeat(docs[first], sizes)
    several = np.repeat(docs[first] < docs[first + sizes - 1], sizes)
    mixed = _mix(key ^ _mix(docs.view(np.uint64) * _ODD))
    columns = {"key": np.where(later, mixed, key).view(np.int64), "doc_id": docs,
               "known": pa.array(key.view(np.int64), mask=~several), "later": later,
               **{k: v.view(np.int64) for k, v in more.items()}}
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


NAMED = "key long, doc_id long, known long, later boolean"
PLACED = NAMED + ", check long, at long, tag long"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_ids, texts in rows_of(batches, CHUNK):
        rows = [(d, t) for d, t in zip(doc_ids, texts) if d is not None]
        ids, found = np.array([d for d, _ in rows], np.int64), []
        for portion in _portions([t for _, t in rows]):
            anchors = Anchors(portion)
            found.append((anchors.text, anchors.name))
        if found:
            text, name = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((text, name))
            once = np.concatenate(([True], (np.diff(text[order]) != 0) | (np.diff(name[order]) != 0)))
            yield _combine(ids[text[order][once]], name[order][once])


HALF = (LENGTH - SHORT) // 2
BLOCK = "name long, block long, doc_id long, span long, tag long, before int, after int"


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each wanted anchor its block, its strings (first, place, number) and its longer names on either side."""
    digest = xxhash.xxh3_64_intdigest
    for doc_ids, tags, names, texts in rows_of(batches, CHUNK):
        marks = np.concatenate([_mix(np.array(n, np.int64).view(np.uint64) ^ _mix(np.full(len(n), i + 1, np.uint64)))
                                for i, n in enumerate(names)])
        rows = []
        for portion in _portions(texts):
            anchors = Anchors(portion)
            own = _mix(anchors.name ^ _mix(anchors.text.astype(np.uint64) + np.uint64(1)))
            chosen = np.flatnonzero(np.isin(own, marks))
            for name, i, j, a, b in zip(anchors.name[chosen].view(np.int64).tolist(), anchors.text[chosen].tolist(),
                                        *[x.tolist() for x in anchors.bounds(chosen)]):
                text = texts[i]
                rows.append((name, _signed(digest(text[a:b + LENGTH])), doc_ids[i], a << 16 | (j - a) << 8 | (b - a), tags[i],
                             digest(text[j - HALF:j + SHORT]) >> 33 if a <= j - HALF else None,
                             digest(text[j:j + SHORT + HALF]) >> 33 if b > j - HALF else None))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64() if k < 5 else pa.int32()) for k, x in enumerate(zip(*rows))],
                [f.split()[0] for f in BLOCK.split(", ")])


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, lower = xxhash.xxh3_128_intdigest, (1 << 64) - 1
    for doc_ids, tags, spans, texts in rows_of(batches, CHUNK):
        docs, at, keys, marks = [], [], [], []
        for doc_id, tag, own, text in zip(doc_ids, tags, spans, texts):
            places = [i for span in own for i in range(span >> 8, (span >> 8) + (span & 255) + 1)]
            if places and not 0 <= min(places) <= max(places) <= len(text) - LENGTH:
                raise ValueError(f"strings outside of a text of {len(text)} bytes")
            keys += [digest(text[i:i + LENGTH]) for i in places]
            at += places
            docs += [doc_id] * len(places)
            marks += [tag] * len(places)
        if docs:
            yield _combine(np.array(docs, np.int64), np.array([k >> 64 for k in keys], np.uint64),
                           check=np.array([k & lower for k in keys], np.uint64), at=np.array(at, np.int64),
                           tag=np.array(marks, np.int64))


def removed_runs(size: int, spans: list | None) -> list[tuple[int, int]]:
    """The runs of a text of ``size`` bytes that ``spans`` (first string and further ones) cover."""
    if not spans:
        return []
    coded = np.array(spans, np.int64)
    change = np.zeros(size + 2, np.int64)
    np.add.at(change, (coded >> 8) + 1, 1)
    np.add.at(change, (coded >> 8) + (coded & 255) + LENGTH + 1, -1)
    edges = np.flatnonzero(np.diff(np.cumsum(change) > 0))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, spans, text): the bytes of each text, whether a smaller document has it whole, strings to remove.

    Null and empty texts have no repeats.  Rows without doc_id are no smaller and
    no larger than any: they lose nothing and no other loses by them.  Rows that
    share a doc_id count as one document, so none repeats another, but each text
    has its own strings to remove.  All decisions are made on the input.
    """
    spark = docs.sparkSession
    # The texts are stored once by doc_id, so that no later step moves them.
    table = f"texts_{uuid.uuid4().hex}"
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (with_text(docs, encoded=True).withColumn("same", F.unhex(F.md5("text")))
     .withColumn("tag", F.xxhash64("text")).repartition(parts, "doc_id")
     .write.bucketBy(parts, "doc_id").option("path", f"{shared_folder(spark)}/{table}")
     .option("compression", "zstd").saveAsTable(table))
    texts = spark.table(table)

    # Tags are needed, and stored with each string, only where a doc_id has several texts.
    several = staged(texts.where("doc_id is not null").groupBy("doc_id")
                     .agg((F.min("same") < F.max("same")).alias("several")).where("several"), "several")
    texts = texts.join(several, "doc_id", "left").withColumn(
        "tag", F.when(F.col("several"), F.col("tag")).otherwise(0)).drop("several")

    # Copies of a whole text are settled by its digest and take no further part.
    owners = texts.groupBy("same").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")).where("n > 1")
    copies = staged(texts.select("doc_id", "same").join(owners, "same").where("owner < doc_id")
                    .groupBy("doc_id").agg(F.collect_set("same").alias("copies")), "copies")
    marked = texts.join(copies, "doc_id", "left")

    def with_own(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
        """Rows with what was found for their doc_id and text; a join on both keys would move the stored texts."""
        other = found.withColumnsRenamed({"doc_id": "_id", "tag": "_tag"})
        own = (F.col("doc_id") == F.col("_id")) & (F.col("tag").bitwiseXOR(F.col("_tag")) == 0)
        return rows.join(other, own, how).drop("_id", "_tag")

    fresh = marked.where("not coalesce(array_contains(copies, same), false)")
    found = fresh.select("doc_id", "text").mapInArrow(_anchor_rows, NAMED).select("key", "doc_id", "known")
    group = Window.partitionBy("key")
    left = (found.withColumn("low", F.min("doc_id").over(group)).withColumn("high", F.max("doc_id").over(group))
            .where("known is not null or low < high")
            .select("doc_id", F.coalesce("known", "key").alias("name")))
    names = staged(left.groupBy("doc_id").agg(F.collect_set("name").alias("names")), "names")
    # A name may stand at several places of a block (periodic text); what is beside it differs by place.
    alike = ["name", "block", "place"]
    held = staged(fresh.join(names, "doc_id").select("doc_id", "tag", "names", "text").mapInArrow(_block_rows, BLOCK)
                  .withColumn("place", F.shiftright("span", 8).bitwiseAND(F.lit(255))), "blocks")
    first = staged(held.groupBy(*alike).agg(
        F.min("doc_id").alias("owner"), F.min("before").alias("before"), F.min("after").alias("after")), "first")
    either = [first.where(f"{side} is not null").groupBy("name", side).agg(F.count("*").alias("n"))
              .where("n > 1").select("name", side, F.lit(True).alias(f"{side}_met")) for side in ("before", "after")]
    opened = (first.join(either[0], ["name", "before"], "left").join(either[1], ["name", "after"], "left")
              .where("before_met or after_met").select(*alike, "owner", "before_met", "after_met"))
    low, place = F.shiftright("span", 16), F.col("place")
    number = F.col("span").bitwiseAND(F.lit(255))
    start = F.when(F.col("before_met"), 0).otherwise(F.greatest(F.lit(0), place - (HALF - 1)))
    end = F.when(F.col("after_met"), number).otherwise(F.least(number, place - HALF))
    asked = staged(held.join(opened, alike).where("doc_id = owner").groupBy("doc_id", "tag").agg(F.collect_set(
        F.shiftleft(low + start, 8).bitwiseOR(end - start)).alias("asked")), "asked")
    strings = with_own(fresh, asked, "inner").select("doc_id", "tag", "asked", "text").mapInArrow(_string_rows, PLACED)
    whole = Window.partitionBy("key", "check")
    again = (strings.withColumn("low", F.min("doc_id").over(whole)).where("later or low < doc_id")
             .select("doc_id", "tag", F.shiftleft("at", 8).alias("span")))
    settled = (held.join(first.select(*alike, "owner"), alike).where("owner < doc_id")
               .select("doc_id", "tag", F.shiftleft(low, 8).bitwiseOR(number).alias("span")))
    spans = staged(staged(again, "again").union(settled).groupBy("doc_id", "tag").agg(
        F.collect_set("span").alias("spans")), "spans")
    copy = F.coalesce(F.array_contains("copies", F.col("same")), F.lit(False))
    return with_own(marked, spans, "left").select("doc_id", copy.alias("copy"), "spans", "text")


def deduplicated(docs: DataFrame, fields: str, row: Callable[[bytes, list[tuple[int, int]]], tuple]) -> DataFrame:
    """doc_id and ``fields`` as ``row(text, removed runs)`` makes them, for each row of ``docs``."""
    schema = f"doc_id long, {fields}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, copied, spans, texts in rows_of(batches, CHUNK):
            made = [row(t, [(0, len(t))] if copy and len(t) >= LENGTH else removed_runs(len(t), x))
                    for t, copy, x in zip(texts, copied, spans)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(doc_ids, pa.int64())}
                | {f.split()[0]: list(x) for f, x in zip(fields.split(", "), zip(*made))})

    return repeats(docs).mapInArrow(run, schema)


def kept_bytes(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in removed for x in span], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def digest_row(text: bytes, removed: list[tuple[int, int]]) -> tuple:
    return (len(text), sum(b - a for a, b in removed), len(removed),
            hashlib.sha256(kept_bytes(text, removed)).hexdigest())


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
