"""SimHash near-dedup; near fingerprints are found by vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, join_small, table
from .components import Sets, components
from .near_sets import set_groups
from .sharding import ATOMIC

#: Fingerprints a leaf should hold, the size from which a leaf is dealt again, and the bound of the sample that a tree is
#: planted on.
LEAF, LARGE, SAMPLE = 4096, 1 << 16, 1 << 16


def fingerprint(raw: bytes, n: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's n-word shingles, repeats included: a bit is 1 if set in over half of their XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    n = min(n, len(words))
    flat, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, ones, hashed = len(words) - n + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 15):
        cuts = zip(starts[at : min(at + (1 << 15), total)].tolist(), ends[at + n - 1 : min(at + (1 << 15), total) + n - 1].tolist())
        h = np.array([hashed(flat[a:b], seed) for a, b in cuts], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [fingerprint(x or b"") for x in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["key", "fp"])


def halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fp & np.uint64(0xFFFFFFFF)).astype(np.uint32), (fp >> np.uint64(32)).astype(np.uint32)


def plant(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A full vantage-point tree as arrays in heap order: each node's vantage point and radius (the median distance). Below
    the nodes that have values of the sample, any values of it are vantage points with half the bits as radius."""
    size = (1 << depth) - 1
    points = np.resize(sample, size) if len(sample) else np.zeros(size, np.uint32)
    radii, parts = np.full(size, 16, np.uint8), {0: sample}
    while parts:
        node, own = parts.popitem()
        if node < size and len(own) > 1:
            points[node] = own[0]
            d = np.bitwise_count(own ^ own[0])
            radii[node] = int(np.median(d))
            parts[2 * node + 1], parts[2 * node + 2] = own[d <= radii[node]][1:], own[d > radii[node]]
    return points, radii


def route(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into x, leaf, guest): each value is at home in one leaf. It is a guest in leaves beyond a boundary that a
    value within reach of it may lie behind; by the triangle bound, other branches hold none. Only values on the inner
    side of a boundary cross it, so two values meet just once at that boundary."""
    points, radii = tree
    at, node, guest = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    for _ in range(depth):
        d, r = np.bitwise_count(x[at] ^ points[node]).astype(np.int16), radii[node].astype(np.int16)
        inner, outer = np.where(guest, d <= r + reach, d <= r), d + reach > r
        crossing = outer & inner
        at, node, guest = np.concatenate((at[inner], at[outer])), np.concatenate((2 * node[inner] + 1, 2 * node[outer] + 2)), np.concatenate((guest[inner], (guest | crossing)[outer]))
    return at, node, guest


def parted(bits: int) -> list[int]:
    """A set of bits as two sets of half as many each."""
    own = [1 << i for i in range(64) if bits >> i & 1]
    return [sum(own[: len(own) // 2]), sum(own[len(own) // 2 :])]


def link(fp: np.ndarray, home: np.ndarray, guest: np.ndarray, bits: int, reach: int, rest: int, most: int, sets: Sets, rng: np.random.Generator) -> None:
    """Joins in sets all homes with homes and guests that differ in at most `most` bits, if in at most reach of `bits`.
    home, guest: indexes into fp; rest: the bits that have not been looked at.

    Large leaves are divided on by further vantage points, small ones are compared in blocks. Where all values agree
    nearly in `bits`, the others tell them apart: of two halves of `rest` one differs in at most most // 2 bits, and each is
    divided by vantage points in its turn.
    """
    if len(home) > 256:
        mask = np.uint64(bits)
        own, others = fp[home] & mask, fp[guest] & mask
        for v in own[rng.integers(len(home), size=3)]:
            d = np.bitwise_count(own ^ v).astype(np.int16)
            r = int(np.median(d))
            r -= r == d.max()
            inside = d <= r
            if inside.any() and max(inside.mean(), 1 - inside.mean()) < 0.95:
                g = np.bitwise_count(others ^ v).astype(np.int16)
                link(fp, home[inside], guest[g <= r + reach], bits, reach, rest, most, sets, rng)
                link(fp, home[~inside], np.concatenate((guest[g + reach > r], home[inside & (d + reach > r)])), bits, reach, rest, most, sets, rng)
                return
        if rest.bit_count() >= 8:
            one, two = parted(rest)
            link(fp, home, guest, one, most // 2, two, most, sets, rng)
            link(fp, home, guest, two, most // 2, one, most, sets, rng)
            return
    for a in range(0, len(home), 512):
        own = home[a : a + 512]
        for others in (home[a:], guest):
            for b in range(0, len(others), 4096):
                near = np.bitwise_count(fp[own][:, None] ^ fp[others[b : b + 4096]][None, :]) <= most
                i, j = np.nonzero(near)
                sets.join(own[i], others[b + j])


def near_links(prints: DataFrame, n: int, most: int = 3) -> DataFrame:
    """From distinct fingerprints (column fp, n of them) links (a, b) that connect all those within `most` (at most 3) bits.

    If two fingerprints differ in at most `most` bits, one of their halves differs in at most most // 2. Each half has a
    vantage-point tree, planted on a bounded sample (at most SAMPLE values, 1 of 128), that deals all fingerprints to
    leaves, and near ones over the boundaries too. In a leaf, links are reduced to one for each member of a component
    there, so a group of copies gives no square of links. A leaf of more than LARGE values, as one of equal halves may
    be, is dealt again by the four bytes of the other half, one of which is equal in any two that are linked.
    """
    if most > 3:
        raise ValueError("bytes of a half tell linked fingerprints apart beyond 3 bits")
    depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
    reach = most // 2
    trees = [(np.zeros(0, np.uint32), np.zeros(0, np.uint8))] * 2
    if depth:
        share = min(SAMPLE, 32 << depth) / n
        picked = prints.where(F.pmod(F.xxhash64("fp", F.lit(11)), F.lit(1 << 40)) < int(share * (1 << 40))).select("fp").limit(2 * SAMPLE).toPandas()["fp"].to_numpy(np.int64)
        picked = np.sort(picked).view(np.uint64)
        np.random.Generator(np.random.PCG64(5)).shuffle(picked)
        trees = [plant(h, depth) for h in halves(picked)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            signed = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, half in enumerate(halves(signed.view(np.uint64))):
                at, leaf, guest = route(half, trees[k], depth, reach)
                yield pa.RecordBatch.from_arrays([pa.array((leaf + (k << 32)).astype(np.int64)), pa.array(signed[at]), pa.array(guest)], ["leaf", "fp", "guest"])

    def meet(t: pa.Table) -> pa.Table:
        signed, guest = t["fp"].to_numpy().astype(np.int64), t["guest"].to_numpy(zero_copy_only=False)
        order = np.lexsort((signed, guest))
        signed, guest = signed[order], guest[order]
        fp = signed.view(np.uint64)
        sets = Sets(len(fp))
        low = (1 << 32) - 1
        bits, rest = (low << 32, low) if t["leaf"][0].as_py() >> 32 else (low, low << 32)
        link(fp, np.flatnonzero(~guest), np.flatnonzero(guest), bits, reach, rest, most, sets, np.random.Generator(np.random.PCG64(3)))
        root = sets.find(np.arange(len(fp)))
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"a": signed[child], "b": signed[root[child]]})

    dealt = cut(prints.select("fp").mapInArrow(deal, "leaf long, fp long, guest boolean").withColumn("part", F.lit(-1)), "leaves")
    large = cut(dealt.groupBy("leaf").count().where(F.col("count") > LARGE).select("leaf"), "large")
    if large.take(1):
        other = F.when(F.col("leaf") < (1 << 32), F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp"))
        byte = lambda k: F.lit(256 * k) + F.shiftrightunsigned(other, 8 * k).bitwiseAND(F.lit(255)).cast("int")
        again = join_small(dealt, large, ["leaf"], "left_semi").select("leaf", "fp", "guest", F.explode(F.array(*map(byte, range(4)))).alias("part"))
        dealt = join_small(dealt, large, ["leaf"], "left_anti").union(again)
    return dealt.groupBy("leaf", "part").applyInArrow(meet, "a long, b long")


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = 3) -> DataFrame:
    """One row per document: key, fp (the 64-bit SimHash of its 3-word shingles, as a long) and component, the smallest
    key that is reachable over links between fingerprints of at most `most` differing bits.

    Null and empty texts have the fingerprint 0 and are linked as any other. Null keys are rows as others and never the
    smallest; a group of null keys alone has a null component. Repeated rows are kept. Other columns are not read.
    """
    rows = cut(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_fingerprints, f"key {docs.schema[key].dataType.simpleString()}, fp long"), "prints")
    prints = cut(rows.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    roots = components(near_links(prints, prints.count(), most), "a", "b")
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = cut(rooted, "rooted")
    least = cut(rooted.groupBy("root").agg(F.min("first").alias("component")), "least")  # written, so that a root's rows can be split
    names = rooted.join(least, "root").select("fp", "component")
    return rows.join(names, "fp").select(F.col("key").alias(key), "fp", "component")


def _identity(docs: DataFrame, text: str, key: str) -> list[Column]:
    """Columns that tell rows apart by what they hold: key, text and all plain columns. They do not depend on where a row is read."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, ATOMIC)]
    return [F.col(key).alias("_k"), F.xxhash64(text).alias("_t"), F.xxhash64(F.lit(1), text).alias("_u"), F.xxhash64(F.lit(2), *plain).alias("_p")]


def one_of_each(docs: DataFrame, rows: DataFrame, group: str, text: str, key: str) -> DataFrame:
    """Of each group the row of docs with the smallest key (null last), then by identity. rows: identities and group.

    A row is chosen by its identity, not by its key: rows without a key, and rows that share one, are judged apart.
    """
    least = F.min(F.struct(F.col("_k").isNull().alias("n"), "_k", "_t", "_u", "_p")).alias("_least")
    counted = rows.groupBy(group, "_k", "_t", "_u", "_p").count()
    kept = cut(counted.groupBy(group).agg(least, F.max("count").alias("_n")).select("_least.*", "_n"), "kept").drop("n")
    ids = ["_k", "_t", "_u", "_p"]
    marked = docs.select(F.struct("*").alias("_in"), *_identity(docs, text, key))
    right = kept.select(*[F.col(c).alias(f"r{c}") for c in ids]).hint("shuffle_merge")
    # one row per kept document: it grows with the input, so it is shuffled at every size
    stay = marked.join(right, F.col("_k").eqNullSafe(F.col("r_k")) & (F.col("_t") == F.col("r_t")) & (F.col("_u") == F.col("r_u")) & (F.col("_p") == F.col("r_p")), "left_semi")
    return (stay.dropDuplicates(ids) if kept.where("_n > 1").take(1) else stay).select("_in.*")


def near_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs that stay: of each group of near copies that with the smallest key.

    Near copies have a Jaccard similarity of 0.8 or more of their 5-word shingles, also by chains. SimHash fingerprints of
    these shingles, searched by the vantage-point trees, connect those within 3 bits. At this similarity fingerprints
    differ in about ten bits and up to 17, where vantage points tell nothing apart, so bands of MinHash propose the other
    pairs (near_sets). All pairs are held against their shingles. Null and empty texts have no words and are copies of each
    other; texts of any length are read whole; of wholly equal rows one stays; an empty table gives no rows; all columns
    stay as they are. Rows are chosen by all that they hold, so reruns agree.
    """
    ids = _identity(docs, text, key)
    kind = f"struct<_k: {docs.schema[key].dataType.simpleString()}, _t: long, _u: long, _p: long>"
    return one_of_each(docs, set_groups(docs, ids, text, kind, near_links), "root", text, key)


def op7_simhash(spark, sf_dir):
    rows = simhash_components(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
