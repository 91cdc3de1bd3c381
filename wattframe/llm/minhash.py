"""MinHash near-duplicates by tensored banding.

A table key needs ``2 * HALF`` minhashes of its own, and missing few links
needs well over a hundred tables.  Here keys are pairs: ``COLLECTED`` values of
``HALF`` minhashes each form the left collection, as many the right one, and
every pair of a left and a right value is a key.  144 tables cost 72 minhashes
instead of 864.  A link of similarity s is missed with probability of at most
2 * (1 - s**HALF) ** COLLECTED, 0.0004 at 0.8 and falling quickly above it.

Equal sets are merged first.  Members of a key's bucket are compared with its
smallest member, its centre.  A parity vector of each set (its bits cannot differ
in more places than the sets do) rules out pairs before whole sets are compared.
Whatever these links leave in different components is then compared across
components, by whole sets in blocks and once for all buckets of a centre: members
of a family share most of their buckets, and pairs listed bucket by bucket would
take most of the time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import components, staged, with_text
from wattframe.operators.joins import join_figures

COLLECTED, HALF = 12, 3
LINK = (80, 100)  # links hold LINK[1] * intersection >= LINK[0] * union
PARITY = 512
AT_ONCE = 1 << 17  # shingles hashed at a time
ROWS_AT_ONCE = 4096  # sets whose keys are combined before they are shuffled
PER_BLOCK = 1000  # members of a centre's buckets that are compared with another such block at a time
NAMES_PER_BLOCK = 1 << 20  # shingles of them
WIDE = 4096  # shingles whose holders are multiplied at a time

_ODD, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _TURN
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """Sorted names of the distinct shingles of two words; of one word its own, of none an empty list."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(_mix(names[:-1] * _ODD + names[1:]) if len(names) > 1 else names)


def collections(sets: list[np.ndarray]) -> np.ndarray:
    """The values of both collections, a row for each (non-empty) set."""
    joined, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    seeds = _mix(np.arange(1, 2 * COLLECTED * HALF + 1, dtype=np.uint64) * _ODD)
    values = np.empty((len(sets), 2 * COLLECTED), np.uint64)
    for i in range(2 * COLLECTED):
        value = np.full(len(sets), i, np.uint64)
        for seed in seeds[i * HALF:(i + 1) * HALF]:
            value = _mix(value * _ODD + np.minimum.reduceat(_mix((joined ^ seed) * _ODD), starts))
        values[:, i] = value
    return values


SKETCH = ("doc_id long, same binary, n_shingles long, digest binary, halves array<long>, parity array<long>")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, same, texts = batch.columns
        held, size, start = [], 0, 0
        for i in range(batch.num_rows):
            held.append(shingles(texts[i].as_buffer().to_pybytes()))
            size += len(held[-1])
            if size >= AT_ONCE or i + 1 == batch.num_rows:
                yield _sketched(ids.slice(start, len(held)), same.slice(start, len(held)), held)
                held, size, start = [], 0, i + 1


def _sketched(ids: pa.Array, same: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
    halves, parities, digests = [None] * len(sets), [None] * len(sets), [None] * len(sets)
    full = [i for i, s in enumerate(sets) if len(s)]
    for i, row in zip(full, collections([sets[i] for i in full]).view(np.int64) if full else ()):
        halves[i] = row
        odd = np.bincount((sets[i] & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
        parities[i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
        digests[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
    lists = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids, same, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
         pa.array(halves, lists), pa.array(parities, lists)], [f.split()[0] for f in SKETCH.split(", ")])


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each key and set; of equal keys of a batch only the smallest set goes under the key itself.

    ``bucket`` is the key where the batch alone shows that several sets have it.
    The last eight bits of a key are the number of its table.
    """
    tables = np.arange(COLLECTED * COLLECTED, dtype=np.uint64).reshape(COLLECTED, COLLECTED)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            ids, halves = (c.slice(start, ROWS_AT_ONCE) for c in batch.columns)
            ids = ids.to_numpy()
            values = halves.flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            left, right = values[:, :COLLECTED, None], values[:, None, COLLECTED:]
            key = (_mix(_mix(left * _ODD + right) + tables * _TURN) & ~np.uint64(255) | tables).ravel()
            own = np.repeat(ids, COLLECTED * COLLECTED)
            order = np.lexsort((own, key))
            key, own = key[order], own[order]
            first = np.append(True, key[1:] != key[:-1])
            sizes = np.diff(np.append(np.flatnonzero(first), len(key)))
            alone = np.repeat(sizes == 1, sizes)
            dealt = np.where(first, key, _mix(key ^ _mix(own.view(np.uint64) * _ODD)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt.view(np.int64)), pa.array(own), pa.array(key.view(np.int64), mask=alone)],
                ["key", "set", "bucket"])


def buckets(sets: DataFrame) -> DataFrame:
    """(bucket, set): the sets of each key that several sets (set, halves) have."""
    rows = sets.select("set", "halves").mapInArrow(_key_rows, "key long, set long, bucket long")
    of_key = Window.partitionBy("key")  # one row for each key and batch at most
    return (rows.withColumn("low", F.min("set").over(of_key)).withColumn("high", F.max("set").over(of_key))
            .where("bucket is not null or low < high")
            .select(F.coalesce("bucket", "key").alias("bucket"), "set"))


def _may_link(a: str, b: str) -> Column:
    """False only for pairs that sizes or parities show to lie below the limit."""
    low, high = LINK
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    apart = sum((F.bit_count(F.col(f"{a}.parity")[i].bitwiseXOR(F.col(f"{b}.parity")[i]))
                 for i in range(PARITY // 64)), F.lit(0))
    return ((F.least(n, m) * high >= F.greatest(n, m) * low)
            & (apart * (high + low) <= (n + m) * (high - low)))


def _confirmed(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their whole sets."""
    low, high = LINK
    met = (pairs.join(whole.select(F.col("set").alias("a"), F.col("names").alias("of_a")), "a")
           .join(whole.select(F.col("set").alias("b"), F.col("names").alias("of_b")), "b"))
    both = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return met.where(both * high >= (F.size("of_a") + F.size("of_b") - both) * low).select("a", "b").distinct()


def _linked(rows: pa.Table) -> pa.Table:
    """One link (a, b) for each two components that have one, of those that are asked for, from whole sets.

    Overlaps are products of matrices: a column for each name that two sets have.
    """
    sets, roots, asks, told = (rows.column(c).to_numpy() for c in ("set", "root", "asks", "told"))
    names = rows.column("names").combine_chunks()
    sizes = names.value_lengths().to_numpy().astype(np.int64)
    _, column, held = np.unique(names.flatten().to_numpy(), return_inverse=True, return_counts=True)
    row, several = np.repeat(np.arange(len(sets)), sizes), held > 1
    row, column = row[several[column]], (np.cumsum(several) - 1)[column[several[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left, right = np.flatnonzero(asks), np.flatnonzero(told)
    both = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(several.sum()), WIDE):
        low, high = np.searchsorted(column, [start, start + WIDE])
        has = np.zeros((len(sets), WIDE), np.float32)
        has[row[low:high], column[low:high] - start] = 1
        both += has[left] @ has[right].T
    low, high = LINK
    either = (sizes[left, None] + sizes[right]) - both
    x, y = np.nonzero((both * high >= either * low) & (roots[left, None] != roots[right]))
    x, y = left[x], right[y]
    ends = np.sort(np.stack([roots[x], roots[y]], axis=1), axis=1)
    first = np.unique(ends, axis=0, return_index=True)[1] if len(x) else np.empty(0, np.int64)
    pair = np.sort(np.stack([sets[x[first]], sets[y[first]]], axis=1), axis=1)
    return pa.table({"a": pa.array(pair[:, 0], pa.int64()), "b": pa.array(pair[:, 1], pa.int64())})


def _across(apart: DataFrame) -> DataFrame:
    """(centre, i, j, set, root, names, told, asks): the rows of each pair of blocks to compare, each listed once.

    Of each centre's rows those outside its largest component ask all others
    (told) whether they are linked.
    """
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = apart.withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")).withColumn(
        "outside", F.col("root") != F.col("top"))
    # Where both are outside, the one of the smaller block asks; in (i, i) a row is there once and does both.
    told = dealt.withColumn("i", F.explode(F.filter(every, lambda i: ~F.col("outside") | (i <= F.col("block")))))
    asks = dealt.where("outside").withColumn("j", F.explode(F.filter(every, lambda j: j != F.col("block"))))
    kept = ["set", "root", "names"]
    return told.select("centre", "i", F.col("block").alias("j"), *kept, F.lit(True).alias("told"),
                       (F.col("outside") & (F.col("i") == F.col("block"))).alias("asks")).union(
        asks.select("centre", F.col("block").alias("i"), "j", *kept, F.lit(False), F.lit(True)))


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) with a < b: confirmed links that connect all linked sets (set, doc_id, same, n_shingles, halves, parity)."""
    met = staged(buckets(sets), "buckets")
    figures = sets.select("set", "n_shingles", "parity")
    shared = sets.join(met.select("set").distinct(), "set", "left_semi")

    # Only sets that share a bucket are made again, from the one row of documents that stands for each.
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                names = shingles(batch.column(1)[i].as_buffer().to_pybytes()).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([names], pa.list_(pa.int64()))], ["set", "names"])

    asked = shared.select("set", F.col("doc_id").alias("_id"), F.col("same").alias("_same"))
    texts = _keyed(docs)
    found = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("same") == F.col("_same")))
    whole = staged(found.select("set", "text").mapInArrow(named, "set long, names array<long>"), "sets")

    held = staged(met.join(figures, "set"), "members")
    centre = held.groupBy("bucket").agg(F.min(F.struct("set", "n_shingles", "parity")).alias("c"))
    stars = join_figures(held, centre, ["bucket"]).alias("x").where("x.c.set < x.set").where(_may_link("x.c", "x"))
    tried = staged(stars.select(F.col("c.set").alias("a"), F.col("set").alias("b")).distinct(), "stars")
    first = staged(_confirmed(tried, whole), "links")

    # What is linked otherwise is compared with its centre only so far; buckets of one centre have most members in common.
    own = (join_figures(met, centre.select("bucket", F.col("c.set").alias("centre")), ["bucket"]).where("set <> centre")
           .join(components(first).withColumnRenamed("node", "set"), "set", "left")
           .select("bucket", "centre", "set", F.coalesce("root", "set").alias("root")))
    mixed = (own.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
             .select("bucket", F.lit(True).alias("mixed")))
    others = staged(join_figures(own, mixed, ["bucket"]).where("mixed").select("centre", "set", "root").distinct()
                    .join(sets.select("set", "n_shingles"), "set"), "others")
    parts = others.groupBy("centre", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("names"))
    sizes = parts.groupBy("centre").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.ceil(F.greatest(
        F.sum("n") / PER_BLOCK, F.sum("names") / NAMES_PER_BLOCK)).cast("int").alias("blocks"))
    apart = staged(join_figures(others.select("centre", "set", "root"), sizes, ["centre"], spread=1)
                   .join(whole, "set"), "apart")
    return first.union(_across(apart).groupBy("centre", "i", "j").applyInArrow(_linked, "a long, b long").distinct())


def _keyed(docs: DataFrame) -> DataFrame:
    encoded = with_text(docs, encoded=True)
    return encoded.select("doc_id", F.unhex(F.md5("text")).alias("same"), "text")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Texts are linked whose sets of distinct two-word shingles have a similarity
    of 0.8 or more; component_id is the smallest doc_id reachable.  Null, empty
    and blank texts have an empty set and are linked with nothing, not even with
    each other.  Repeated rows share a result.  Rows without doc_id take part;
    they name no component unless no other row is in it (then null), and are
    kept only there.  An empty table gives an empty result.
    """
    marked = staged(_keyed(docs).mapInArrow(_sketches, SKETCH).withColumn("row", F.monotonically_increasing_id()),
                    "sketches")
    stands = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "row", "same", "n_shingles", "halves", "parity")
    sets = staged(marked.where("digest is not null").groupBy("digest").agg(F.min(stands).alias("s"))
                  .select("digest", "s.*").withColumnRenamed("row", "set"), "distinct")
    roots = components(links(docs, sets)).withColumnRenamed("node", "set")
    linked = sets.join(roots, "set").select("digest", "doc_id", "root")
    least = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = staged(linked.join(least, "root").select("digest", "component_id").union(
        sets.join(roots, "set", "left_anti").select("digest", "doc_id")), "named")
    full = join_figures(marked.where("digest is not null").select("doc_id", "n_shingles", "digest"), named, ["digest"])
    empty = marked.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").union(empty).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
