"""Near-duplicates by banded MinHash, odd sketches and full sets.

One pass over the texts gives each its set size, a digest of the set, 32 band keys of four MinHash
samples each, and an odd sketch: every one of 256 samples flips one bit of a 1,024-bit map, so
the exclusive-or of two maps counts the samples that differ, most precisely where few do. Two sets
of similarity 0.75 miss each other in all bands with a chance of 5e-6.

Texts of equal sets form a class that is worked on once. In each bucket of a band the members are
paired with one leader, another one in each bucket; pairs whose sketches differ too much are left
out; each text's best pair is confirmed on the full sets first, then those that still connect
different components. What can still be similar across components is found by an index over the
rarest shingles of the members of such buckets, which every two similar sets share one of. So
neither a bucket of thousands of copies nor a family around the threshold costs more than a few
comparisons each, and yet no pair that matters goes unseen.

Nulls and edges: a null or wordless text has the empty set, is linked with nothing and is kept. A
null id never names a component unless all its ids are null; rows that repeat both id and text are
in one component. Other columns, of any name, are ignored or passed on. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.graph import components
from trialbook.llm.tasks import remote
from trialbook.llm.text import LOWER, UPPER, WORD, table, whole
from trialbook.session import stage

SHINGLE, BANDS, ROWS = 5, 32, 4
SAMPLES, BITS = 256, 1024
PERCENT = 75
# Two sets at 0.75 differ in 64 of 256 samples on average, which sets 113 bits with a deviation of 13; five
# deviations are left as a margin, so the sketch loses fewer links than the bands do. Pairs below 0.57 mostly fail.
MOST_BITS = 180

SLOTS = 1 << 22

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_CACHE = 300_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the multipliers are odd constants of a common finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """64-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, hashes: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text."""
    words = text.encode().translate(_LOWER).split()  # splits at the six blanks of the contract
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total = (total + h[k : n - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(mix(total))


_RANDOM = np.random.default_rng(7)
_MULTIPLY = _RANDOM.integers(0, 2**63, SAMPLES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, SAMPLES, dtype=np.uint64)[:, None]


def samples(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of the permutations."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 256):  # parts that stay in the cache
        part = shingles[None, at : at + 256] * _MULTIPLY
        part += _ADD
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """A parity bitmap in 64-bit parts: each sample flips one bit."""
    bits = mix(least ^ (np.arange(len(least), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))) % np.uint64(BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.uint64)


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_hash, n_shingles, digest, bands, sketch) of batches of (doc_id, text_hash, text)."""
    hashes = WordHash()
    names = ["doc_id", "text_hash", "n_shingles", "digest", "bands", "sketch"]
    for batch in batches:
        sizes, digests, bands, sketches = [], [], [], []
        for t in batch.column(2):
            shingles = shingle_set(t.as_py(), hashes)
            sizes.append(len(shingles))
            if len(shingles):
                least = samples(shingles)
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                bands.append(band_keys(least).view(np.int64))
                sketches.append(odd_sketch(least).view(np.int64))
            else:
                digests.append(None), bands.append(None), sketches.append(None)
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, longs), pa.array(sketches, longs)], names=names)


def full_sets(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(_id, _hash, _digest, shingles) of those of (doc_id, text_hash, slot, text) whose slot is in the bit map."""
    hashes = WordHash()
    for batch in batches:
        slots = batch.column(2).to_numpy()
        taken = np.flatnonzero((bits[slots >> 6] >> (slots & 63)) & 1)
        sets = [shingle_set(batch.column(3)[i].as_py(), hashes) for i in taken.tolist()]
        rows = pa.array(taken)
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(rows), batch.column(1).take(rows), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
            pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["_id", "_hash", "_digest", "shingles"])


def slot(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS))


def bits_apart(a: Column, b: Column) -> Column:
    """Population count of the exclusive-or of two sketches."""
    parts = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(BITS // 64)]
    return sum(parts[1:], parts[0])


def may_link(common: Column, a: Column, b: Column) -> Column:
    """Whether sets of these sizes with so many shingles in common are similar enough."""
    return common * 100 >= (a + b - common) * PERCENT


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    sized = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", common.alias("common"), F.size("s").alias("n"), F.size("t").alias("m"))
    return sized.filter(may_link(F.col("common"), F.col("n"), F.col("m"))).select("a", "b")


def _links(reps: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(node, label) of the classes that are linked with others; None if there are none."""
    banded = reps.select("node", F.explode("bands").alias("key"))
    shared = stage(banded.groupBy("key").count().filter("count > 1"), "shared-bands")
    rows = stage(banded.join(shared, "key"), "buckets")
    if rows.isEmpty():
        return None
    # A bucket is led by its member with most company in all its buckets: in a group of copies of one text that is one
    # of the least changed, which the others are most likely linked with.
    weight = rows.groupBy("node").agg(F.sum("count").alias("weight"))
    leaders = stage(rows.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("leader")), "leaders")
    star = rows.join(leaders, "key").filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    sketches = reps.select("node", "sketch", "n_shingles")
    first = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("p"), F.col("n_shingles").alias("n"))
    second = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("q"), F.col("n_shingles").alias("m"))
    sized = star.join(first, "a").join(second, "b").filter(may_link(F.least("n", "m"), F.col("n"), F.col("m")))
    near = sized.select("a", "b", bits_apart(F.col("p"), F.col("q")).alias("bits"))
    near = stage(near.filter(F.col("bits") <= MOST_BITS), "near")

    wanted = rows.select("node").distinct().join(reps.select("node", "rep_id", "text_hash", "digest"), "node")
    wanted = stage(wanted.withColumn("_slot", slot("rep_id", "text_hash")), "wanted")
    # Texts outside the candidates are left out by a bit map of fixed size before anything is shuffled; what
    # passes by accident goes in the join.
    bits = np.zeros(SLOTS // 64, dtype=np.int64)
    one = F.expr("shiftleft(1L, CAST(_slot % 64 AS INT))")
    for r in wanted.groupBy(F.expr("_slot div 64").alias("part")).agg(F.bit_or(one).alias("bits")).collect():  # at most SLOTS / 64 rows
        bits[r["part"]] = r["bits"]
    hashed = texts.select("doc_id", "text_hash", slot("doc_id", "text_hash"), "text")
    found = hashed.mapInArrow(remote(full_sets, bits), "_id long, _hash long, _digest binary, shingles array<long>")
    same = F.col("_id").eqNullSafe(F.col("rep_id")) & (F.col("_hash") == F.col("text_hash")) & (F.col("_digest") == F.col("digest"))
    sets = stage(found.join(wanted, same).select("node", "shingles").dropDuplicates(["node"]), "sets")

    best = near.groupBy("a").agg(F.min(F.struct("bits", "b"))["b"].alias("b"))
    labels = components(stage(confirmed(best, sets), "links"))

    def label(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))

    def open_pairs(pairs: DataFrame) -> DataFrame:
        known = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
        return known.filter(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")

    labels = components(stage(confirmed(open_pairs(near), sets), "links"), labels)
    placed = rows.join(labels, "node", "left").select("node", "key", F.coalesce("label", "node").alias("label"))
    mixed = stage(placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key"), "mixed")
    members = stage(placed.join(mixed, "key").select("node", "label").distinct(), "members")
    # An index over the rarest shingles. Two sets with enough in common share one of the first n - ceil(0.75 n) + 1 of each
    # in any order of all shingles, and the first they share leaves enough behind it in both. Rarest first, texts
    # that have only the body of a family in common do not meet; shingles of one component join nothing.
    shingles = sets.join(members, "node").select("node", "label", F.explode("shingles").alias("shingle"))
    spread = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    ordered = F.sort_array(F.collect_list(F.struct("n", "shingle", (F.col("low") < F.col("high")).alias("joins"))))
    ranked = shingles.join(spread, "shingle").groupBy("node", "label").agg(ordered.alias("ranked"))
    size = F.size("ranked")
    first = F.slice("ranked", F.lit(1), size - F.ceil(size * PERCENT / 100).cast("int") + 1)
    index = ranked.select("node", "label", size.alias("size"), F.posexplode(first).alias("place", "rare")).filter("rare.joins")
    index = stage(index.select("node", "label", "size", (F.col("size") - F.col("place")).alias("behind"), F.col("rare.shingle").alias("shingle")), "rarest")
    one, two = (index.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "label", "size", "behind")]) for side in "ab")
    possible = may_link(F.least("a_behind", "b_behind"), F.col("a_size"), F.col("b_size"))
    rest = one.join(two, (one["shingle"] == two["shingle"]) & (F.col("a_label") < F.col("b_label")) & possible)
    rest = rest.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    sketched = rest.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("p")), "a").join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("q")), "b")
    rest = sketched.filter(bits_apart(F.col("p"), F.col("q")) <= MOST_BITS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    seen = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = stage(confirmed(rest.join(seen, ["a", "b"], "left_anti"), sets), "links")
    return labels if links.isEmpty() else components(links, labels)


def _classified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component, component_id) of every row; ``component`` is NULL for wordless rows only."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(whole(text)).alias("text_hash"), whole(text).alias("text"))
    signed = texts.mapInArrow(remote(sign), "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>, sketch array<long>")
    signed = stage(signed.withColumn("_row", F.monotonically_increasing_id()), "signatures")
    # One row per set: all its rows have the same bands and sketch.
    classes = signed.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("_row").alias("node"), F.min("doc_id").alias("least"), F.min(F.struct("_row", "doc_id", "text_hash")).alias("rep"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"))
    classes = stage(classes.select("digest", "node", "least", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("text_hash"), "bands", "sketch", "n_shingles"), "classes")
    labels = _links(classes, texts)
    named = classes.select("digest", "node", "least")
    if labels is None:
        owners = named.select("digest", F.col("node").alias("component"), F.col("least").alias("component_id"))
    else:
        labelled = named.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
        linked = stage(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "components")
        owners = stage(labelled.join(linked, "component").select("digest", "component", "component_id"), "owners")
    rows = signed.select("doc_id", "text_hash", "n_shingles", "digest").join(owners, "digest", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "text_hash", "n_shingles", "component", own.alias("component_id"))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row: the smallest id reachable over links
    between texts whose sets of five-word shingles have a similarity of 0.75 or more."""
    rows = _classified(docs, doc_id, text)
    return rows.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, one of each component: that of the smallest id (NULL last) and, among
    texts of one id, the smallest hash. All wordless rows stay. Columns may have any name."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    kept = _classified(docs, doc_id, text).filter("component IS NOT NULL").groupBy("component").agg(first.alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("r"), F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("hash"), whole(text).rlike(WORD).alias("worded"))
    joined = packed.filter("worded").join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")))
    # Rows of one id and text are alike to this operator.
    one = F.row_number().over(Window.partitionBy("kept_id", "kept_hash").orderBy("kept_id"))
    chosen = joined.withColumn("n", one).filter("n = 1").select("r")
    return chosen.unionByName(packed.filter(~F.col("worded")).select("r")).select("r.*")


@query("op2_minhash_near_dedup")
def _(spark, folder):
    return near_dedup(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
