"""Groups of near-equal texts by MinHash with tensored bands.

A document's set holds its distinct ``shingle``-word shingles as 64-bit hashes. ``BANDS`` band hashes of ``WIDTH`` minima each
are computed once; the keys of the tables are all pairs of two band hashes, so C(18, 2) = 153 tables of six minima each
cost 54 minima in place of 918. Two sets of similarity 0.8 share no key with probability 5e-5, of 0.85 with 1e-6.

1. Equal sets are one class. What follows works on classes.
2. A band hash that only one class has can be in no shared key and is dropped before keys are made.
3. In every bucket each class is linked to the bucket's smallest one, and the links are verified on the full sets.
   Connected components come from large-star and small-star steps.
4. In buckets that still hold several components, every class outside the bucket's largest component meets all classes of
   other components. So each two classes that share a bucket are in one component or have been compared: a bucket loses no
   link, and a group of thousands of copies makes no pairs within itself.

Cases: a null or empty text has an empty set and is linked with nothing. Rows repeated under one id are one document with equal
sets and are kept together; a component whose ids are all null has a null id, and its rows are kept. With fewer words than
a shingle the whole sequence is one. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sinks.stage import stage

SHINGLE, PERCENT = 5, 80
BANDS, WIDTH = 18, 3
MEMO = 300_000
#: 64-bit words of a set's parity bits.
PARITY_WORDS = 8

_U = np.uint64
_RNG = np.random.default_rng(20)
_FLIP = _RNG.integers(0, 2**63, BANDS * WIDTH, dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**63, BANDS * WIDTH, dtype=np.uint64) * _U(2) + _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


class Shingler:
    """Sorted distinct shingle hashes of texts; remembers hashes of words."""

    def __init__(self, size: int) -> None:
        self.size, self.memo = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: lower case and white space of ASCII only
        if not words:
            return np.empty(0, dtype=np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in words:
            if w not in memo:
                memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(h))
        out = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            out = _mixed(out * _U(0xD6E8FEB86659FD93) + h[i : len(h) - size + 1 + i])
        return np.unique(out)


def band_hashes(shingles: np.ndarray) -> list[int]:
    """BANDS hashes, each of WIDTH minima, as signed 64-bit numbers."""
    least = np.full(BANDS * WIDTH, 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(shingles), 4096):
        x = shingles[None, start : start + 4096]
        np.minimum(least, _mixed((x ^ _FLIP[:, None]) * _TIMES[:, None]).min(1), out=least)
    bands = least.reshape(BANDS, WIDTH)
    out = np.arange(BANDS, dtype=np.uint64)
    for i in range(WIDTH):
        out = _mixed(out * _U(0xD6E8FEB86659FD93) + bands[:, i])
    return out.view(np.int64).tolist()


def parity(shingles: np.ndarray) -> list[int]:
    """A bit per slot: whether an odd number of shingles falls into it.

    Each shingle that only one of two sets has turns one bit, so the bits in which two sets differ are at most
    as many as the shingles in which they do.
    """
    slots = PARITY_WORDS * 64
    odd = np.bincount((shingles % _U(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


_SIGNED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_key", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


def text_key(text: Column) -> Column:
    """Names a text; only used together with other checks."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(doc_id, text_key, n, digest of the set, bands) of every row."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("t"))

    def run(batches):
        cut = Shingler(shingle)
        for batch in batches:
            n, digest, bands = [], [], []
            for t in batch.column(2):
                s = cut(t.as_py())
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(band_hashes(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ], names=_SIGNED.names)

    return rows.mapInArrow(run, _SIGNED)


def _buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, node, pivot) of the tables' keys that at least two classes have, and (band, node) of shared bands.

    The pivot of a bucket is its class whose bands are shared most: where texts were varied from one original,
    that is the original, to which all are closer than to each other.
    """
    bands = classes.select("node", F.posexplode("bands").alias("place", "value"))
    bands = bands.select("node", F.xxhash64("place", "value").alias("band"))
    shared = stage(bands.groupBy("band").agg(F.count("*").alias("k")).where("k > 1"), "shared-bands")
    held = stage(bands.join(shared, "band"), "held-bands")
    lists = held.groupBy("node").agg(F.array_sort(F.collect_list("band")).alias("b"), F.sum("k").alias("known"))
    lists = lists.where(F.size("b") > 1)
    pairs = F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("b") - 1),
        lambda i: F.transform(F.slice("b", i + 1, F.size("b")), lambda y: F.xxhash64(F.element_at("b", i), y)),
    ))
    rows = stage(lists.select("node", "known", F.explode(pairs).alias("key")), "band-pairs")
    many = rows.groupBy("key").agg(F.count("*").alias("k"), F.max("known").alias("known")).where("k > 1").drop("k")
    many = stage(many, "shared-pairs")
    buckets = stage(rows.join(many.withColumnRenamed("known", "most"), "key"), "buckets")
    pivots = buckets.where("known = most").groupBy("key").agg(F.min("node").alias("pivot"))
    return stage(buckets.select("key", "node").join(stage(pivots, "pivots"), "key"), "pivoted"), held.select("band", "node")


def _sets(docs: DataFrame, text: str, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles, parity bits) of the classes in ``nodes`` (node, text_key)."""
    texts = docs.select(text_key(F.col(text)).alias("text_key"), F.col(text).alias("t"))
    found = texts.join(nodes, "text_key").select("node", "t").dropDuplicates(["node"])
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("s", numbers), T.StructField("bits", numbers)])

    def run(batches):
        cut = Shingler(shingle)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [cut(t.as_py()) for t in part.column(1)]
                columns = [[x.view(np.int64) for x in sets], [parity(x) for x in sets]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.list_(pa.int64())) for c in columns)], names=schema.names
                )

    return stage(found.mapInArrow(run, schema), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    both = pairs.join(left, "a").where(_close(F.size("x"), F.col("nb"), percent)).join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    linked = common * 100 >= (F.size("x") + F.size("y") - common) * percent
    return stage(both.where(linked).select("a", "b"), name)


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _alike(a: Column, b: Column, total: Column, percent: int) -> Column:
    """Parity bits of two sets of ``total`` shingles that allow the similarity."""
    differing = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(PARITY_WORDS)), F.lit(0))
    return differing * (100 + percent) <= total * (100 - percent)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``edges`` (a, b); the component is its smallest node."""
    stars = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "large-star")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stage(large.distinct(), "large")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        stars = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small")
        after = mark(stars)
        if after == before:
            break
        before = after
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _labelled(classes: DataFrame, edges: DataFrame) -> DataFrame:
    found = stage(components(edges), "components")
    return classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id, kept) of every row.

    ``component`` numbers the groups of this run; it is null for an empty set.
    """
    signed = stage(signatures(docs, key, text, shingle), "signatures")
    bands = [F.max(F.col("bands")[i]).alias(f"b{i}") for i in range(BANDS)]
    grouped = signed.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min("text_key").alias("text_key"), F.max("n").alias("n"), *bands
    )
    classes = grouped.select(
        F.monotonically_increasing_id().alias("node"), "digest", "id", "text_key", "n",
        F.array(*(f"b{i}" for i in range(BANDS))).alias("bands"),
    )
    classes = stage(classes, "classes")  # numbers are fixed from here on
    buckets, held = _buckets(classes.select("node", "bands"))
    sizes = classes.select("node", "n")

    def sized(pairs: DataFrame) -> DataFrame:
        """(a, b, nb) of the pairs whose sizes allow a link."""
        a, b = sizes.toDF("a", "na"), sizes.toDF("b", "nb")
        both = pairs.join(a, "a").join(b, "b")
        return both.where(_close(F.col("na"), F.col("nb"), percent)).select("a", "b", "nb")

    stars = buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    stars = stage(sized(stars), "star-pairs")
    touched = buckets.select("node").distinct().join(classes.select("node", "text_key"), "node")
    sets = _sets(docs, text, touched, shingle)
    # most of a class's buckets have one pivot: that pair first
    often = buckets.where("node <> pivot").groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("k"))
    often = often.join(stars, ["a", "b"]).groupBy("b").agg(F.max(F.struct("k", "a", "nb")).alias("m"))
    first = stage(often.select("m.a", "b", "m.nb"), "first-pairs")
    links = _verified(first, sets, percent, "links-first")
    if not touched.isEmpty():
        place = stage(_labelled(sizes, links).select("node", "component"), "places")
        apart = _apart(stars, place)
        links = links.unionByName(_verified(apart, sets, percent, "links-stars"))
        place = stage(_labelled(sizes, links).select("node", "component"), "places")
        # also without a star pair of close sizes: two classes of a bucket can be alike, and its pivot much larger
        rest = _across(held, place.join(sizes, "node"), sets, percent)
        more = _verified(stage(sized(rest), "across-pairs"), sets, percent, "links-across")
        links = links.unionByName(more)
    placed = _labelled(classes.select("node", "digest", "id"), links)
    names = stage(placed.groupBy("component").agg(F.min("id").alias("component_id")), "component-names")
    named = stage(placed.join(names, "component").select("digest", "component", "component_id"), "named-classes")
    out = signed.select("doc_id", "text_key", "n", "digest").join(named, "digest", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "component", own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def _apart(pairs: DataFrame, place: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    a = place.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = place.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(a, "a").join(b, "b").where("ca <> cb").drop("ca", "cb")


def _across(held: DataFrame, place: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that share two bands and can be similar enough.

    Where a band joins several components, the classes outside its largest one meet those of other components. Of
    a set only the shingles that a second set of such bands has can be in an intersection, which bounds the
    similarity of a pair, and of a class with all others of a band, before any two sets are compared; so do the
    parity bits, which tell copies changed in different places apart. Both bounds are exact: no link is lost.
    """
    rows = stage(held.join(place, "node"), "band-places")
    counted = rows.groupBy("band", "component").agg(F.count("*").alias("k"))
    mixed = counted.groupBy("band").agg(F.count("*").alias("parts"), F.max(F.struct("k", "component")).alias("top"))
    mixed = stage(mixed.where("parts > 1").select("band", F.col("top.component").alias("largest")), "mixed-bands")
    rows = stage(rows.join(mixed, "band"), "mixed-rows")
    shingles = sets.join(rows.select("node").distinct(), "node", "left_semi").select("node", F.explode("s").alias("x"))
    known = stage(shingles.groupBy("x").agg(F.count("*").alias("k")).where("k > 1").select("x"), "known-shingles")
    common = stage(shingles.join(known, "x", "left_semi").groupBy("node").agg(F.count("*").alias("c")), "known-counts")
    rows = stage(rows.join(common, "node"), "counted-rows")
    limits = stage(rows.groupBy("band").agg(F.min("n").alias("low"), F.max("c").alias("top")), "band-limits")
    most = F.least("c", "top")
    rows = rows.join(limits, "band").where(most * 100 >= (F.col("n") + F.greatest("low", most) - most) * percent)
    rows = stage(rows.drop("low", "top").join(sets.select("node", "bits"), "node"), "possible-rows")
    few = rows.where("component <> largest").select(
        "band", "largest", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("c").alias("cc"),
        F.col("bits").alias("other"),
    )
    # two classes that are both outside the largest component meet twice; the smaller one asks
    ask = (F.col("ca") != F.col("component")) & ((F.col("component") == F.col("largest")) | (F.col("a") < F.col("node")))
    most = F.least("c", "cc")
    ask = ask & (most * 100 >= (F.col("n") + F.col("na") - most) * percent)
    ask = ask & _alike(F.col("bits"), F.col("other"), F.col("n") + F.col("na"), percent)
    met = few.join(rows.drop("largest"), "band").where(ask)
    pairs = met.groupBy(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).agg(F.count("*").alias("k"))
    return pairs.where("k > 1").select("a", "b")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")
