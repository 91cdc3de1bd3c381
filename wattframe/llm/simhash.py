"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 * r`` bits share a value within
``r`` bits of both, so a shuffle on such variants brings every pair together.
A full ball (r = 2) over 64 bits has 2,081 variants.  They are needed for few
fingerprints only:

1. Leave out one of three blocks of bits.  Of four differing bits one block
   holds two at least (or all differing bits are in one), so the two blocks
   kept differ in two bits at most for some choice, and balls of radius 1 over
   them meet: 132 variants instead of 2,081.
2. Groups of up to ``SMALL`` fingerprints on such a variant are compared pair by
   pair.  Members of larger groups emit their full balls: a shared variant
   proves at most four differing bits, so each member is tied to the smallest
   of the group and no pairs are listed.

Equal fingerprints are merged first, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import components, hex16, row_key, staged, thinned, with_text

WIDTH = 4  # words in a shingle
SEED = 42
BLOCKS = ((0, 22), (22, 43), (43, 64))
SMALL = 24
AT_ONCE = 1 << 16  # shingles whose bits are spread at a time


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The fingerprint of one text as an unsigned number; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[width - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), AT_ONCE):
        part = hashes[i:i + AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _printed(rows: DataFrame, names: str) -> DataFrame:
    """The columns of ``rows`` but the last, which is the encoded text, and its fingerprint ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            values = [fingerprint(x.as_buffer().to_pybytes()) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(np.array(values, np.uint64).view(np.int64))], [*batch.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, f"{names}, fp long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row; fp is the signed form of the 64 bits."""
    return _printed(with_text(docs, encoded=True), "doc_id long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(bits: list[int], most: int) -> list[int]:
    """All masks of at most ``most`` of ``bits``."""
    masks = [0] + [1 << b for b in bits]
    if most > 1:
        masks += [1 << a | 1 << b for i, a in enumerate(bits) for b in bits[:i]]
    return [_signed(m) for m in masks]


def _ball(fps: DataFrame, masks: list[int], kept: int = -1) -> DataFrame:
    flips = F.array(*[F.lit(m) for m in masks]) if len(masks) < 200 else F.from_json(
        F.lit(str(masks)), "array<bigint>")
    base = F.col("fp").bitwiseAND(F.lit(_signed(kept & (1 << 64) - 1)))
    return fps.select("fp", base.alias("base"), F.explode(flips).alias("flip")).select(
        "fp", F.col("base").bitwiseXOR(F.col("flip")).alias("variant"))


def near_pairs(fps: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints that connect all within four bits of another.

    Pairs within four bits are connected by the result, not all of them listed.
    """
    parts = []
    for low, high in BLOCKS:
        bits = [b for b in range(64) if not low <= b < high]
        parts.append(_ball(fps, _flips(bits, 1), sum(1 << b for b in bits))
                     .select(F.lit(low).alias("left_out"), "variant", "fp"))
    variants = parts[0].union(parts[1]).union(parts[2])
    key = ["left_out", "variant"]
    # One shuffle, whatever the size: counting first and joining the counts back would move the variants again.
    met = staged(variants.withColumn("n", F.count("*").over(Window.partitionBy(*key))).where("n > 1"), "met")
    few, many = met.where(F.col("n") <= SMALL), met.where(F.col("n") > SMALL)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    small = (few.select(*key, F.col("fp").alias("a"))
             .join(few.select(*key, F.col("fp").alias("b")), key)
             .where("a < b").select("a", "b").where(apart <= 4).distinct())
    # Not joined: Spark takes exploded rows for as many bytes as their source and would broadcast them.
    balls = _ball(many.select("fp").distinct(), _flips(list(range(64)), 2))
    large = (balls.select(F.min("fp").over(Window.partitionBy("variant")).alias("a"), F.col("fp").alias("b"))
             .where("a <> b").distinct())
    return small.union(large)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) for each row of ``docs``.

    Fingerprints link at four or fewer differing bits; component_id is the
    smallest doc_id reachable.  Texts without words (null, empty, blank) have
    fingerprint zero and link like any other.  Repeated rows share a result;
    rows without doc_id take part and never name a component unless alone in
    it (then null).  An empty table gives an empty result.
    """
    marked = staged(fingerprints(docs), "fingerprints")
    named = _named(staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fps"))
    return marked.join(named, "fp").select("doc_id", "fp", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame) -> DataFrame:
    """(key): the ``row_key`` of one row of each component, whatever ids its rows have or share.

    It is the row of the smallest doc_id, rows without one come last, and of
    unlike texts with this doc_id that of the smallest digest.
    """
    plain = with_text(docs)
    texts = plain.select("doc_id", row_key(plain).alias("key"), F.col("text").cast("binary").alias("text"))
    marked = staged(_printed(texts, "doc_id long, key string"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "key")
    fps = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(order).alias("row")), "fps")
    named = _named(fps.select("fp", "first"))
    return fps.join(named, "fp").groupBy("root").agg(F.min("row").alias("row")).select("row.key")


def _named(fps: DataFrame) -> DataFrame:
    """(fp, root, component_id) from (fp, first): root tells components apart, component_id is their smallest ``first``."""
    roots = components(thinned(near_pairs(fps.select("fp"))))
    joined = fps.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = joined.groupBy("root").agg(F.min("first").alias("linked"))
    linked = staged(joined.join(least, "root").select("fp", "root", "linked"), "linked")
    lone = fps.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                 F.coalesce("linked", "first").alias("component_id"))
    return staged(lone, "named")
