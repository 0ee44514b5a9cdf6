"""Near-duplicates by MinHash: one-permutation signatures, banded buckets, star-shaped candidate edges.

1. A text's signature takes one hash per shingle; empty bins are filled by optimal densification.
   Texts with the same shingle set are one class, stood for by its smallest id.
2. Classes meet in band buckets. A bucket of n classes makes n - 1 candidates: a star around the
   class that meets the most others in all its buckets, as an original does among its edited copies.
   Candidates are confirmed on the full shingle sets.
   Those that the parities of their sets show to be too far apart are left out before texts are fetched.
3. A star can miss a link between two of its rays. In a bucket whose rays still hold several components, up to
   ``ASKERS`` classes outside its largest component are compared with all others and leave it. The classes of
   buckets that are mixed even then are taken up again by an exact set join: shingles are ordered by how few of these classes have them, and a similar pair must share one of the first ``n - ceil(s * n) + 1`` of each.
   What a bucket has in common without being similar, a passage say, comes last in that order. Only
   pairs across components are compared; inside a component no further link matters, so shingles of one
   component only come first and meet nothing.
4. Connected components over the confirmed links.

What later steps don't read is deleted from the shared folder as soon as its readers are written.

Thus every pair that shares a band bucket is compared, connected otherwise, or proven dissimilar:
nothing is capped. With ``bands`` of ``rows`` bins, a pair of similarity s shares no bucket with
probability (1 - s**rows)**bands: 5e-8 for 0.8 with the defaults.

Cases: texts without shingles (null, empty, white space) are linked with nothing, and so are rows
without an id. Rows that repeat an id are one document with several texts: each of the texts is compared, and all
links are links of the id. Ids are whole numbers. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from returnscope.llm import shingles
from returnscope.llm.common import hot_keys, narrowed, repeated_keys, salted_join, with_spare_numbers
from returnscope.llm.components import components
from returnscope.sources.tables import release_staged, stage, staged_paths

ASKERS = 8
PARTS = 1024
SIGNATURE = "id long, size long, key1 long, key2 long, bands array<long>"


def _signer(kind: str, k: int, bands: int, rows: int):
    bins = 1 << (bands * rows - 1).bit_length()
    if bins != bands * rows:
        raise ValueError("bands times rows must be a power of two")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for first, data, offsets in shingles.chunks(column):
                n = len(offsets) - 1
                keys = shingles.distinct(*shingles.SHINGLERS[kind](data, offsets, k))
                size, key1, key2 = shingles.set_digests(keys, n)
                hashes = shingles.band_hashes(shingles.signatures(keys, n, bins), rows)
                lists = pa.ListArray.from_arrays(pa.array(range(0, n * bands + 1, bands), pa.int32()), pa.array(hashes.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n), pa.array(size), pa.array(key1), pa.array(key2), lists], ["id", "size", "key1", "key2", "bands"]
                )

    return sign


def _confirmer(kind: str, k: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, union = shingles.overlaps(batch.column(2), batch.column(3), kind, k)
            linked = pa.array((common > 0) & (100 * common >= percent * union))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(linked), batch.column(1).filter(linked)], ["a", "b"])

    return confirm


def _confirmed(pairs: DataFrame, texts: DataFrame, kind: str, k: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets are similar enough. ``texts`` has ``id, text``, an id once."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    other = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    full = pairs.join(one, "a").join(other, "b").select("a", "b", "ta", "tb")
    return full.mapInArrow(_confirmer(kind, k, percent), "a long, b long")


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", kind: str = "words", k: int = 5,
    percent: int = 80, bands: int = 32, rows: int = 4,
) -> DataFrame:
    """``id, size, component`` for every row: size of its shingle set, smallest id reachable by links."""
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    repeated = repeated_keys(source.select("id"), "id")
    if repeated.isEmpty():
        return groups_of_numbered(source, kind, k, percent, bands, rows)
    # Each text of a repeated id gets a number of its own; the components of an id's numbers are joined afterwards.
    sha = F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha")
    texts = source.join(repeated, "id", "left_semi").select("id", sha).distinct()
    texts = with_spare_numbers(texts, ["id", "sha"], source.select("id"))
    numbered = source.select("id", "text", sha).join(texts, ["id", "sha"], "left").select(F.coalesce("node", "id").alias("id"), "text")
    grouped = groups_of_numbered(numbered, kind, k, percent, bands, rows).withColumnRenamed("id", "node")
    real = grouped.join(texts.select("node", "id"), "node", "left").select(F.coalesce("id", "node").alias("id"), "size", "component")
    real = stage(real, "rows_of_repeated")
    first = real.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a != b")
    edges = real.join(first.select("id", "a"), "id").select("a", F.col("component").alias("b")).distinct()
    joined = components(edges, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    whole = real.join(joined, "component", "left").select("id", "size", F.coalesce("whole", "component").alias("component"))
    whole = stage(whole, "joined_by_id")
    smallest = whole.groupBy("component").agg(F.min("id").alias("smallest"))
    out = salted_join(whole.filter("component IS NOT NULL"), smallest, "component", hot_keys(whole, "component"), ["id", "size"])
    return out.select("id", "size", F.col("smallest").alias("component")).unionByName(whole.filter("component IS NULL"))


def groups_of_numbered(source: DataFrame, kind: str, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_groups`` of ``id, text`` where equal ids have equal texts."""
    earlier = set(staged_paths(source.sparkSession))
    signed = stage(source.mapInArrow(_signer(kind, k, bands, rows), SIGNATURE), "signatures")
    sizes = stage(signed.select("id", "size"), "sizes")
    linked = _linked(source, signed, earlier, kind, k, percent)
    return sizes.join(linked, "id", "left").select("id", "size", F.coalesce("component", "id").alias("component"))


def linked_numbers(source: DataFrame, kind: str, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``id, component`` of those ids of ``groups_of_numbered`` that share their component with others."""
    earlier = set(staged_paths(source.sparkSession))
    signed = stage(source.mapInArrow(_signer(kind, k, bands, rows), SIGNATURE), "signatures")
    return _linked(source, signed, earlier, kind, k, percent)


def _linked(source: DataFrame, signed: DataFrame, earlier: set[str], kind: str, k: int, percent: int) -> DataFrame:
    """``id, component`` of ids that are linked with others; deletes what was staged after ``earlier``, ``sizes`` excepted."""
    spark = source.sparkSession

    def release(*keep: str) -> None:
        """Delete what has been staged here, other than tables of the given names."""
        kept = ("sizes", "twins", *keep)
        release_staged(spark, [p for p in staged_paths(spark) if p not in earlier and p.rsplit("/", 1)[1].rsplit("-", 1)[0] not in kept])

    usable = signed.filter((F.col("size") > 0) & F.col("id").isNotNull())
    # Most buckets have one row and go right behind the only shuffle of all entries. Equal sets share all buckets.
    filled = stage(_repeated_buckets(usable), "filled")
    some = stage(filled.select("id").distinct(), "filled_ids")
    equal = ["key1", "key2", "size"]
    sets = stage(narrowed(usable.select("id", *equal), some, "id").join(some, "id", "left_semi"), "sets")
    classes = sets.groupBy(*equal).agg(F.min("id").alias("rep"), F.max("id").alias("last")).filter("rep < last").drop("last")
    twins = stage(sets.join(classes, equal).select("id", "rep").distinct(), "twins")
    release("filled")
    met = filled.join(twins.filter("id != rep").select("id"), "id", "left_anti").select("bucket", "id")
    met = stage(_several(met.distinct()), "met")
    release("met")
    degree = met.groupBy("id").agg(F.sum("n").alias("degree"))
    shared = met.join(degree, "id").select("bucket", "id", "degree")
    shared = stage(shared, "buckets")
    release("buckets")
    hubs = shared.groupBy("bucket").agg(F.max_by("id", _rank()).alias("hub"))
    rays = stage(shared.join(hubs, "bucket").filter("id != hub").select("bucket", "id", "degree", "hub"), "rays")
    release("rays")
    compared = stage(rays.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct(), "stars")

    ends = compared.select(F.col("a").alias("id")).unionByName(compared.select(F.col("b").alias("id"))).distinct()
    ends = stage(ends, "ends")
    texts = narrowed(source, ends, "id").join(ends, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    texts = stage(texts, "candidate_texts")
    sketches = stage(texts.mapInArrow(_sketches(kind, k), "id long, n long, parity array<long>"), "sketches")
    likely = stage(_likely(compared, sketches, percent), "likely")
    links = stage(_confirmed(likely, texts, kind, k, percent), "confirmed")
    found = stage(components(links, "a", "b"), "components")
    kept = ("candidate_texts", "sketches", "stars", "asked", "components")
    release(*kept, "rays")

    rays = stage(_mixed(rays.select("bucket", "id", "degree"), found), "open_rays")
    release(*kept, "open_rays")
    if not rays.isEmpty():
        askers = stage(_askers(rays), "askers")
        asked = stage(_asked(rays, askers).join(compared, ["a", "b"], "left_anti"), "asked")
        likely = stage(_likely(asked, sketches, percent), "likely")
        found = _merged(found, stage(_confirmed(likely, texts, kind, k, percent), "confirmed"))
        rays = rays.join(askers, ["bucket", "id"], "left_anti").select("bucket", "id", "degree")
        rays = stage(_mixed(rays, found), "open_rays")
        release(*kept, "open_rays")
        if not rays.isEmpty():
            pairs = _missed(rays.select("bucket", "id"), found, compared.unionByName(asked), texts, sketches, kind, k, percent)
            release("candidate_texts", "components", "pairs_across")
            found = _merged(found, stage(_confirmed(pairs, texts, kind, k, percent), "confirmed"))
    release("components")
    labels = found.select(F.col("node").alias("rep"), "component")
    whole = twins.join(labels, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    whole = stage(whole.unionByName(labels.withColumnRenamed("rep", "id")).distinct(), "linked")
    release("linked")
    return whole


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` with more ``links`` between them: only components that are linked take part."""
    one, two = (found.select(F.col("node").alias(side), F.col("component").alias("c" + side)) for side in "ab")
    roots = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = stage(components(roots, "a", "b"), "joined")
    whole = found.join(joined.toDF("component", "whole"), "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    return stage(whole.unionByName(joined.join(found, "node", "left_anti")), "components")


def _mixed(rays: DataFrame, found: DataFrame) -> DataFrame:
    """``bucket, id, degree, component, top`` of the buckets with several components; ``top`` is a bucket's largest."""
    labels = found.select(F.col("node").alias("id"), "component")
    placed = rays.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = F.max_by("component", F.struct("n", "component")).alias("top")
    mixed = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), largest).filter("parts > 1")
    return placed.join(mixed.select("bucket", "top"), "bucket")


def _askers(rays: DataFrame) -> DataFrame:
    """``bucket, id, component`` of a mixed bucket's first classes outside its largest component."""
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("degree"), "id"))
    return rays.filter("component != top").withColumn("place", place).filter(F.col("place") <= ASKERS).select("bucket", "id", "component")


def _asked(rays: DataFrame, askers: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of askers with their bucket's classes of other components, at most ``ASKERS`` a class and bucket."""
    others = rays.select("bucket", F.col("id").alias("other"), F.col("component").alias("whole"))
    met = others.join(askers, "bucket").filter("component != whole")
    return met.select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct()


def _several(entries: DataFrame) -> DataFrame:
    """``entries`` of buckets with several rows, and their number ``n``."""
    return entries.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).filter("n > 1")


def _repeated_buckets(signed: DataFrame) -> DataFrame:
    """``bucket, id`` of the entries of all ``bands`` whose bucket has several."""
    dealt = signed.select("id", "bands").mapInArrow(_dealt, "part int, bucket array<long>, id array<long>")
    return dealt.repartition("part").select("bucket", "id").mapInArrow(_shared, "bucket long, id long")


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's entries as a row for each of the ``PARTS`` that buckets fall into, so that a shuffle moves few rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bands = batch.column(1)
        bucket = bands.flatten().to_numpy()
        ids = np.repeat(batch.column(0).to_numpy(), bands.value_lengths().to_numpy())
        part = (bucket & (PARTS - 1)).astype(np.uint16)
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part, minlength=PARTS)
        parts = np.flatnonzero(counts)
        edges = pa.array(np.concatenate(([0], np.cumsum(counts[parts]))), pa.int32())
        lists = [pa.ListArray.from_arrays(edges, pa.array(values[order])) for values in (bucket, ids)]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *lists], ["part", "bucket", "id"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket, id`` of a partition's buckets with several entries. It is held as numbers, 16 bytes an entry."""
    columns = [tuple(column.flatten().to_numpy() for column in batch.columns) for batch in batches]
    if not columns:
        return
    bucket, ids = (np.concatenate(parts) for parts in zip(*columns))
    del columns
    order = np.argsort(bucket)
    bucket = bucket[order]
    n = np.diff(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))))
    rows = np.flatnonzero(np.repeat(n > 1, n))
    for first in range(0, len(rows), 1 << 16):
        some = rows[first : first + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[some]), pa.array(ids[order[some]])], ["bucket", "id"])


def _rank():
    """Order of a bucket's classes as centres of a star."""
    return F.struct("degree", -F.col("id"))


def _parities(keys: np.ndarray, size: np.ndarray) -> pa.ListArray:
    """A text's set as bits, one where an odd number of its shingles fall.

    There are two to four bits a shingle and a power of two of them, so that the two halves of a
    longer list, combined by exclusive or, compare with a shorter one.
    """
    words = 1 << np.ceil(np.log2(np.maximum(size, 32) / 32)).astype(np.int64)
    edges = np.concatenate(([0], np.cumsum(words)))
    owner = (keys >> np.uint64(shingles.HASH_BITS)).astype(np.int64)
    bit = keys & (words[owner] * 64 - 1).astype(np.uint64)
    out = np.zeros(edges[-1], np.uint64)
    np.bitwise_xor.at(out, edges[owner] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(out.view(np.int64)))


def _sketches(kind: str, k: int):
    """``n`` is the size of a text's set, ``parity`` its parities."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, data, offsets in shingles.chunks(batch.column(1)):
                n = len(offsets) - 1
                keys = shingles.distinct(*shingles.SHINGLERS[kind](data, offsets, k))
                size = shingles.set_digests(keys, n)[0]
                yield pa.RecordBatch.from_arrays([ids.slice(first, n), pa.array(size), _parities(keys, size)], ["id", "n", "parity"])

    return sketch


def _sets(kind: str, k: int):
    """``own`` has a text's shingles."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, component = batch.column(0), batch.column(1)
            for first, data, offsets in shingles.chunks(batch.column(2)):
                n = len(offsets) - 1
                keys = shingles.distinct(*shingles.SHINGLERS[kind](data, offsets, k))
                size = shingles.set_digests(keys, n)[0]
                edges = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
                own = pa.ListArray.from_arrays(edges, pa.array((keys & shingles.HASH_MASK).view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(first, n), component.slice(first, n), own], ["id", "component", "own"])

    return split


def _at_least_apart(one: str, two: str) -> Column:
    """Shingles that only one of two sets has, at least: their parities differ in no more places."""
    x, y = F.col(one), F.col(two)
    either = lambda left, right: F.zip_with(left, right, lambda u, v: u.bitwiseXOR(v))
    ones = lambda bits: F.aggregate(bits, F.lit(0), lambda n, word: n + F.bit_count(word))
    halved = lambda bits, half: either(F.slice(bits, 1, half), F.slice(bits, half + 1, half))
    return (
        F.when(F.size(x) == F.size(y), ones(either(x, y)))
        .when(F.size(x) == 2 * F.size(y), ones(either(halved(x, F.size(y)), y)))
        .when(F.size(y) == 2 * F.size(x), ones(either(halved(y, F.size(x)), x)))
        .otherwise(F.lit(0))
    )


def _near_enough(nx: str, ny: str, px: str, py: str, percent: int) -> Column:
    """False where the sizes or the parities of two sets rule out that they are similar."""
    both = F.col(nx) + F.col(ny)
    close = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    return close & ((both - _at_least_apart(px, py)) * (100 + percent) >= 2 * percent * both)


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that may be similar by their sketches."""
    one, two = (sketches.select(F.col("id").alias(side), F.col("n").alias("n" + side), F.col("parity").alias("p" + side)) for side in "ab")
    return pairs.join(one, "a").join(two, "b").filter(_near_enough("na", "nb", "pa", "pb", percent)).select("a", "b")


def _missed(
    rays: DataFrame, found: DataFrame, compared: DataFrame, texts: DataFrame, sketches: DataFrame, kind: str, k: int, percent: int
) -> DataFrame | None:
    """Pairs of different components that the stars left open; None if no bucket's rays are of two components."""
    labels = found.select(F.col("node").alias("id"), "component")
    placed = rays.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    parts = placed.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    mixed = stage(parts.filter("c1 != c2").select("bucket"), "mixed_buckets")
    if mixed.isEmpty():
        return None
    open_ids = stage(placed.join(mixed, "bucket", "left_semi").select("id", "component").distinct(), "open_classes")
    sets = texts.join(open_ids, "id").select("id", "component", "text").mapInArrow(_sets(kind, k), "id long, component long, own array<long>")
    tokens = sets.select("id", "component", F.size("own").alias("n"), F.explode("own").alias("token"))
    # A shingle of one component comes first in that order and meets nothing, so the rest is ranked behind it.
    having, whole = Window.partitionBy("token"), Window.partitionBy("id")
    spread = tokens.withColumns({"df": F.count("*").over(having), "c1": F.min("component").over(having), "c2": F.max("component").over(having)})
    ordered = spread.filter("c1 != c2").drop("c1", "c2")
    ranked = ordered.withColumns({"r": F.row_number().over(whole.orderBy("df", "token")), "s": F.count("*").over(whole)})
    # Of a similar pair's shingles, percent / (100 + percent) are in both sets. So each must share percent
    # of its own with other components, and one of the two twice the former share.
    entries = ranked.filter((F.col("s") * 100 >= F.col("n") * percent) & (F.col("r") <= F.col("s") - F.ceil(F.col("n") * percent / 100) + 1))
    entries = entries.select("token", "id", "component", "n", "s", (F.col("s") * (100 + percent) >= 2 * percent * F.col("n")).alias("ample"))
    entries = stage(entries, "open_prefixes")
    several = entries.groupBy("token").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.max("ample").alias("any"))
    several = several.filter("c1 != c2 AND any").select("token")
    rows = entries.join(several, "token", "left_semi").join(sketches.select("id", "parity"), "id")
    columns = ("id", "component", "n", "s", "parity")
    one = rows.filter("ample").select("token", *[F.col(c).alias(c + "x") for c in columns])
    two = rows.select("token", *[F.col(c).alias(c + "y") for c in columns], "ample")
    across = one.join(two, "token").filter(
        (F.col("componentx") != F.col("componenty"))
        & (~F.col("ample") | (F.col("idx") < F.col("idy")))
        & (F.least("sx", "sy") * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent)
        & _near_enough("nx", "ny", "parityx", "parityy", percent)
    )
    pairs = across.select(F.greatest("idx", "idy").alias("a"), F.least("idx", "idy").alias("b")).distinct()
    return stage(pairs.join(compared, ["a", "b"], "left_anti"), "pairs_across")


def one_per_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows that stay, with the input's columns: the smallest id of each group, with all rows that bear it, and rows without an id."""
    groups = near_groups(docs, id_column, text_column, **options)
    gone = groups.filter(F.col("id").isNotNull() & (F.col("id") != F.col("component"))).select(F.col("id").alias("_gone")).distinct()
    return docs.join(gone, F.col(f"`{id_column}`") == F.col("_gone"), "left_anti")
