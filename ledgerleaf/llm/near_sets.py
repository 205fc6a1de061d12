"""Near copies by 5-word shingles: SimHash trees and MinHash bands propose pairs, exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, discard, join_small
from .components import Sets, components
from .substring_dedup import _pair, names
from .words import word_hashes

#: Words of a shingle, and the similarity of near copies as a fraction. A pair at it shares none of the bands with a
#: probability of (1 - 0.8 ** 6) ** 34 < 0.00004.
SHINGLE, LIKE = 5, (4, 5)
BANDS, ROWS = 34, 6
#: Least shingles of a set by which it is compared first: sets of no more are compared by all they have.
HEAD = 512
#: Bytes of text that are hashed at once, and members of a bucket that a block holds.
AT_ONCE, BLOCK = 1 << 18, 384
_SEEDS = np.random.Generator(np.random.PCG64(23)).integers(0, 1 << 63, (BANDS * ROWS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """Of each text the distinct 64-bit names of its shingles, sorted. A shorter text is one shingle, and so are all empty ones."""
    hashes, ends = word_hashes([t.lower() for t in texts])
    x, out = names(hashes, SHINGLE), []
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        out.append(np.unique(x[a : b - SHINGLE + 1]) if b - a >= SHINGLE else names(hashes[a:b], b - a) if b > a else np.zeros(1, np.uint64))
    return out


def _name(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes())


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each set the names of its bands (of ROWS least hashes each) and its SimHash."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    found = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sets), band, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = _pair(h, np.minimum.reduceat(flat * _SEEDS[k, 0] + _SEEDS[k, 1], starts))
        found[:, band] = h
    ones = np.add.reduceat(np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), starts, axis=0, dtype=np.int64)
    half = np.diff(np.append(starts, len(flat)))[:, None]
    return found, np.packbits(2 * ones > half, axis=1, bitorder="little").view(np.uint64).ravel()


def _parts(texts: list[bytes | None]) -> Iterator[list[np.ndarray]]:
    """The shingles of texts, about AT_ONCE bytes at a time."""
    part, n = [], 0
    for raw in texts:
        part.append(raw or b"")
        if (n := n + len(part[-1])) >= AT_ONCE:
            yield shingles(part)
            part, n = [], 0
    if part:
        yield shingles(part)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, at = b.column(0), 0
        for sets in _parts(b.column(1).cast(pa.binary()).to_pylist()):
            found, fp = signatures(sets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), _signed(found.reshape(-1)))
            sid = np.fromiter(map(_name, sets), np.uint64, len(sets))
            yield pa.RecordBatch.from_arrays([ids.slice(at, len(sets)), _signed(sid), _signed(fp), lists], ["id", "sid", "fp", "bands"])
            at += len(sets)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in _parts(b.column(0).cast(pa.binary()).to_pylist()):
            ends = pa.array(np.cumsum([0, *map(len, part)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([_signed(np.fromiter(map(_name, part), np.uint64, len(part))), pa.ListArray.from_arrays(ends, _signed(np.concatenate(part)))], ["sid", "s"])


def _alike(common: Column, both: Column) -> Column:
    """Whether common shingles of `both` in the union make near copies."""
    return common * LIKE[1] >= both * LIKE[0]


def verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is LIKE or more. contents: sid, s."""
    one, two = contents.select(F.col("sid").alias("a"), F.col("s").alias("sa")), contents.select(F.col("sid").alias("b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one, "a").join(two, "b").where(_alike(common, F.size("sa") + F.size("sb") - common)).select("a", "b")


def _agree(n: np.ndarray, heads: list[np.ndarray], head: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of sets are near copies as far as their heads tell, and for which the heads are all they have.

    Below the lesser of two heads' ends, what is common of both is a sample of what is common of the sets. Of u values
    at a similarity of 0.8 at least 0.8 u - 1.8 sqrt(u) are common but for a probability of 0.00001.
    """
    m, flat = len(heads), np.concatenate(heads)
    values, at, many = np.unique(flat, return_inverse=True, return_counts=True)
    row, place = np.repeat(np.arange(m), [len(h) for h in heads]), np.cumsum(many > 1) - 1
    common, width = np.zeros((m, m), np.float32), max(1, (1 << 20) // m)
    row, column = row[many[at] > 1], place[at[many[at] > 1]]
    for a in range(0, int(column.max(initial=-1)) + 1, width):
        part = (column >= a) & (column < a + width)
        x = np.zeros((m, width if column.max() >= a + width else int(column.max()) - a + 1), np.float32)
        x[row[part], column[part] - a] = 1
        common += x @ x.T
    whole = n <= head
    end = np.where(whole, np.uint32(0xFFFFFFFF), np.array([h[-1] for h in heads], np.uint32))
    below = np.stack([np.searchsorted(h, end, "right").astype(np.float32) for h in heads])
    both = below + below.T - common
    exact = whole[:, None] & whole[None, :]
    return np.where(exact, LIKE[1] * common >= LIKE[0] * both, common >= 0.8 * both - 1.8 * np.sqrt(both)), exact


def _compare(sid: np.ndarray, root: np.ndarray, n: np.ndarray, heads: list[np.ndarray], most: int, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block that agree and have different roots, as (a, b, more). Of pairs that are exact enough that connect
    the roots; of others the first `most` that would connect the same two roots. more: others of these two roots are left."""
    agree, exact = _agree(n, heads, head)
    i, j = np.nonzero(np.triu(agree & (root[:, None] != root[None, :]), 1))
    sure = exact[i, j]
    names_, code = np.unique(root, return_inverse=True)
    sets, picked, left = Sets(len(names_)), [], np.flatnonzero(sure)
    while len(left):
        a, b = sets.find(code[i[left]]), sets.find(code[j[left]])
        left, a, b = left[a != b], a[a != b], b[a != b]
        own = np.unique(np.concatenate((np.unique(a, return_index=True)[1], np.unique(b, return_index=True)[1])))
        picked.append(left[own])
        sets.join(a[own], b[own])
    i_open, j_open = i[~sure], j[~sure]
    x, y = np.minimum(root[i_open], root[j_open]), np.maximum(root[i_open], root[j_open])
    order = np.lexsort((sid[i_open], sid[j_open], y, x))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    start, group = np.flatnonzero(new), np.cumsum(new) - 1
    kept = np.arange(len(order)) - start[group] < most if len(order) else new
    many = np.diff(np.append(start, len(order))) > most
    own = np.concatenate([*picked, np.flatnonzero(~sure)[order[kept]]]).astype(np.int64)
    more = np.concatenate((np.zeros(len(own) - int(kept.sum()), bool), many[group[kept]] if len(order) else kept))
    return np.maximum(sid[i[own]], sid[j[own]]), np.minimum(sid[i[own]], sid[j[own]]), more


def prefix_members(large: DataFrame, contents: DataFrame) -> DataFrame:
    """Other buckets for sets (sid, root) whose own ones are large: members (g, sid, root, index) by their rarest shingles.

    Of two sets at a similarity of a / b or more, with shingles in one order, the larger has one of the smaller's first
    1 / 9 (n - 2a / (a + b) n, plus one: index) among its own first 1 / 5 (n - a / b n, plus one). In order of how many of
    these sets have a shingle, those that a template gives to all come last, so pages of one template meet only if they
    share what few have. What more than BLOCK sets have counts as equally frequent. No pair at the bound is missed.
    """
    own = cut(contents.join(large.select("sid"), "sid", "left_semi"), "large")
    each = own.select("sid", F.explode("s").alias("g"))
    shared = cut(each.groupBy("g").agg(F.least(F.count("*"), F.lit(BLOCK + 1)).alias("n")).where("n > 1"), "shared")
    ordered = F.array_sort(F.collect_list(F.struct("n", "g")))
    listed = each.join(shared, "g").groupBy("sid").agg(ordered.alias("list")).join(own.select("sid", F.size("s").alias("n")), "sid")
    alone = F.col("n") - F.size("list")  # shingles that no other set has come first
    first = lambda a, b: F.col("n") - F.ceil(F.col("n") * a / b).cast("int") + 1 - alone
    most = F.greatest(F.lit(0), first(*LIKE))
    kept = listed.select("sid", first(2 * LIKE[0], LIKE[0] + LIKE[1]).alias("i"), F.posexplode(F.slice("list", F.lit(1), most)).alias("at", "x"))
    members = cut(kept.select("sid", F.col("x.g").alias("g"), (F.col("at") < F.col("i")).alias("index")).join(large, "sid"), "members")
    useful = members.groupBy("g").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.max("index").alias("z")).where("x <> y AND z")
    return members.join(cut(useful.select("g"), "useful"), "g", "left_semi").select("g", "sid", "root", "index")


def block_pairs(members: DataFrame, heads: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b, more) of members of the same bucket that have different roots and heads that agree.

    members: g (bucket), sid, root, index; heads: sid, n, head. Small buckets share a task. The members of a large one are
    dealt to blocks: those that need not meet each other (of its most frequent root, which are connected already, or those
    that are not index, whichever are more), and the others; each block of others meets every block once, so no task holds a
    large bucket.
    """
    roots = members.groupBy("g", "root").agg(F.count("*").alias("count"), F.count_if(~F.col("index")).alias("guests"))
    sizes = cut(roots.groupBy("g").agg(F.max(F.struct("count", "root")).alias("main"), F.sum("count").alias("m"), F.sum("guests").alias("guests")), "sizes")
    packs = max(1, members.count() // (4 * BLOCK))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    by_guest = F.col("guests") > F.col("main.count")
    is_main = F.when(by_guest, ~F.col("index")).otherwise(F.col("root") == F.col("main.root"))
    n_main = F.greatest("guests", F.col("main.count"))
    nm, nr = blocks(n_main), blocks(F.col("m") - n_main)
    own = F.pmod(F.xxhash64("sid"), F.when(is_main, nm).otherwise(nr)).cast("int")
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    rest = F.concat(F.transform(upto(nr), lambda r: pair(F.least(own, r), F.greatest(own, r))), F.transform(upto(nm), lambda k: pair(own, nr + k)))
    met = F.when(F.col("m") <= BLOCK, F.array(pair(F.lit(-1), F.lit(-1)))).when(is_main, F.transform(upto(nr), lambda r: pair(r, nr + own))).otherwise(rest)
    dealt = members.join(sizes.where(F.col("m") > n_main), "g").withColumn("p", F.explode(met)).select("g", "p.i", "p.j", "sid", "root")
    size = HEAD  # goes to the workers with the closure
    at = F.when(F.col("i") < 0, F.pmod(F.xxhash64("g"), F.lit(packs))).otherwise(F.xxhash64("g", "i", "j"))

    def meet(t: pa.Table) -> pa.Table:
        g, i, j, sid, root, n = (t[c].to_numpy() for c in ("g", "i", "j", "sid", "root", "n"))
        lists = t["head"].combine_chunks()
        values, ends = lists.flatten().to_numpy().view(np.uint32), np.cumsum(lists.value_lengths().to_numpy())
        head = np.split(values, ends[:-1])
        order = np.lexsort((sid, j, i, g))
        cuts = np.flatnonzero((np.diff(g[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        found = [_compare(sid[o], root[o], n[o], [head[k] for k in o], most, size) for o in np.split(order, cuts)]
        a, b, more = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64), "more": more.astype(bool)}).group_by(["a", "b"]).aggregate([("more", "max")]).rename_columns(["a", "b", "more"])

    dealt = dealt.withColumn("at", at).join(heads, "sid")
    return dealt.groupBy("at").applyInArrow(meet, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))


def set_links(members: DataFrame, first: DataFrame, contents: DataFrame) -> DataFrame:
    """(node, root) of all sets that links of a similarity of LIKE or more connect with others.

    members: g (bucket), sid; first: pairs to begin with; contents: sid, s. Large groups of near copies are connected by the
    first pairs; what is not yet connected in a bucket is compared, by all that small sets have and the heads of large ones:
    the members of a bucket of at most BLOCK all with each other, those of larger ones in buckets by their rarest shingles
    instead (prefix_members), where alone blocks may meet blocks. Of two groups some pairs of large sets are held against the sets first; others follow only if these do
    not connect the two.
    """
    head = F.transform(F.slice("s", 1, HEAD), lambda h: F.shiftright(h, 32).cast("int"))
    heads = cut(contents.select("sid", F.size("s").alias("n"), head.alias("head")), "heads")
    n = lambda c: heads.select(F.col("sid").alias(c), F.col("n").alias(f"n{c}"))
    sized = first.join(n("a"), "a").join(n("b"), "b").where(_alike(F.least("na", "nb"), F.greatest("na", "nb"))).select("a", "b")
    checked, most, more = cut(sized.distinct(), "pairs"), 4, True
    roots = cut(components(verified(checked, contents), "a", "b"), "roots")
    while more:
        left = members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        several = left.groupBy("g").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m")).where("x <> y").select("g", (F.col("m") > BLOCK).alias("large"))
        left = cut(left.join(cut(several, "several"), "g"), "open").withColumn("index", F.lit(True))
        large = cut(left.where("large").select("sid", "root").distinct(), "large")
        left = left.where("NOT large").drop("large")
        if large.take(1):
            left = left.unionByName(prefix_members(large, contents))
        left = cut(left, "open")
        agree = cut(block_pairs(left, heads, most), "agree")
        more, most = bool(agree.where("more").take(1)), 8 * most
        pairs = cut(agree.select("a", "b").join(checked, ["a", "b"], "left_anti"), "pairs")
        discard(left)
        discard(agree)
        checked, found = checked.union(pairs), cut(verified(pairs, contents), "found")
        if found.take(1):
            roots = cut(components(found.union(roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))), "a", "b"), "roots")
    return roots


def set_groups(docs: DataFrame, ids: list[Column], text: str, kind: str, tree_links) -> DataFrame:
    """One row per document: its identity (ids, a struct of type `kind`) and root, the same for all that near copies connect.

    Documents with one set of shingles are one node. Pairs come from tree_links (prints, n), which connects near SimHash
    fingerprints, and from buckets by bands of MinHash; the texts of sets that may have a partner are read again for
    their shingles, and the pairs are held against these.
    """
    named = docs.select(F.struct(*ids).alias("id"), F.col(text).alias("text"))
    rows = cut(named.mapInArrow(_signatures, f"id {kind}, sid long, fp long, bands array<long>").select("id.*", "sid", "fp", "bands"), "sets")
    dealt = rows.select(F.explode("bands").alias("g"), "sid")
    shared = cut(dealt.groupBy("g").agg(F.min("sid").alias("hub"), F.max("sid").alias("other")).where("hub <> other").select("g", "hub"), "shared")
    members = cut(dealt.join(shared, "g").distinct(), "buckets")
    star = members.where("sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
    prints = cut(rows.groupBy("fp").agg(F.min("sid").alias("first"), F.max("sid").alias("last")), "distinct")
    links = tree_links(prints.select("fp"), prints.count())
    end = lambda c: prints.select(F.col("fp").alias(c), F.col("first").alias(f"s{c}"))
    near = links.join(end("a"), "a").join(end("b"), "b").select(F.col("sa").alias("a"), F.col("sb").alias("b"))
    same = rows.select("fp", "sid").join(prints.where("first <> last"), "fp").select(F.col("sid").alias("a"), F.col("first").alias("b"))
    first = star.union(near).union(same).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    first = cut(first.distinct(), "first")
    needed = cut(first.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "needed")
    told = cut(rows.select("sid", "_t", "_u").join(needed, "sid", "left_semi").dropDuplicates(["sid"]), "told")
    texts = join_small(docs.select(F.col(text).alias("text"), *ids[1:3]), told.select("_t", "_u"), ["_t", "_u"], "left_semi").select("text")
    contents = cut(texts.mapInArrow(_contents, "sid long, s array<long>").dropDuplicates(["sid"]), "contents")
    roots = set_links(members.select("g", "sid"), first, contents)
    return rows.drop("bands", "fp").join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
