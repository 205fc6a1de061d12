"""Benchmark decontamination by suffix arrays over shards of the training documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, rows_where, table, with_results

#: Bytes of the table that maps A-Z to a-z and all other ASCII but a-z and 0-9 to a space.
FOLD = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Benchmark text that one pass over the documents searches for, and document text that one suffix array holds (or one document).
PASS_BYTES, SHARD_BYTES = 16 << 20, 8 << 20
#: Places of items whose runs are put together at once.
AT_ONCE = 1 << 20

HITS = "array<struct<start: int, end: int>>"
MATCHES = "array<struct<doc_word: int, item_word: int, n_words: int, item_id: string>>"
RESULT = f"n_words long, n_hit long, items array<string>, matches {MATCHES}, hits {HITS}"


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


class Queries:
    """The test suffixes: the words of all items as numbers, a 0 after each item, and the suffixes that begin a window of
    n words for each length n. Their order by first words is made once in each Python worker."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.ids, self.vocabulary, lists = [i for i, _ in items], {}, []
        for _, text in items:
            found = words_of((text or "").encode())
            lists.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found] + [0], np.int32))
        self.ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
        self.flat = np.concatenate([*lists, np.zeros(window, np.int32)])
        self.window, self.bits = window, max(1, len(self.vocabulary).bit_length())
        self.per = max(1, min(window, 62 // self.bits))
        self._groups: list | None = None

    def key(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The `per` words from each place on, packed into a whole number that sorts as they do."""
        key = flat[at].astype(np.int64)
        for k in range(1, self.per):
            key = (key << self.bits) | flat[at + k]
        return key

    def groups(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each window length n: n, the suffixes that begin a window of n words in order of their first words, and these."""
        if self._groups is None:
            length = np.diff(self.ends, prepend=0) - 1
            own, self._groups = np.minimum(length, self.window), []
            for n in np.unique(own[own > 0]).tolist():
                of = np.flatnonzero(own == n)
                many = length[of] - n + 1
                at = np.repeat(self.ends[of] - 1 - length[of], many) + spread(many)
                key = self.key(self.flat, at)
                order = np.argsort(key, kind="stable")
                self._groups.append((n, at[order], key[order]))
        return self._groups

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_groups": None}


def spread(many: np.ndarray) -> np.ndarray:
    """0 to m - 1 for each m of many, one after the other."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def occurrences(ids: np.ndarray, q: Queries) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each window length n: (n, places in ids where a test suffix begins, the range of each, the test suffixes found, the
    range of each): places and suffixes of one range agree in n words, and no pairs of them are made. ids: the words of all
    documents of a shard, 0 for words in no item and after each document, and as many 0 at the end as a window has words.

    The suffix array of the shard is sorted by the suffixes' first words; every test suffix is looked up in it by binary
    search. Only the ranges that are found are sorted on by the words that follow, until n words agree.
    """
    known = np.flatnonzero(ids[: len(ids) - q.window])
    known = known[ids[known] > 0]
    key = q.key(ids, known)
    order = np.argsort(key, kind="stable")
    suffixes, key = known[order], key[order]
    for n, tests, first in q.groups():
        rest = q.bits * max(0, q.per - n)
        low, high = np.searchsorted(key, first >> rest << rest, "left"), np.searchsorted(key, (first >> rest) + 1 << rest, "left")
        met = np.flatnonzero(high > low)
        own, start = np.unique(low[met], return_inverse=True)
        many = high[met][np.unique(low[met], return_index=True)[1]] - own
        at, at_range = suffixes[np.repeat(own, many) + spread(many)], np.repeat(np.arange(len(own)), many)
        test, test_range = tests[met], start
        for done in range(q.per, n, q.per):  # the words that follow, the last ones as far as n
            rest = q.bits * max(0, done + q.per - n)
            a, b = q.key(ids, at + done) >> rest, q.key(q.flat, test + done) >> rest
            values, of = np.unique(np.concatenate((a, b)), return_inverse=True)
            of = np.concatenate((at_range, test_range)) * np.int64(len(values)) + of
            of = np.unique(of, return_inverse=True)[1]
            a, b = of[: len(at)], of[len(at) :]
            both = np.intersect1d(a, b)
            stay, ask = np.isin(a, both), np.isin(b, both)
            at, at_range, test, test_range = at[stay], a[stay], test[ask], b[ask]
        ranges = np.unique(at_range)
        yield n, at, np.searchsorted(ranges, at_range), test, np.searchsorted(ranges, test_range)


def _runs(n: int, at: np.ndarray, of: np.ndarray, test: np.ndarray, test_of: np.ndarray, q: Queries) -> Iterator[tuple[int, int, int, int]]:
    """For every item, the verbatim runs of the places in it: (place, item, word of the item, words). A place begins at the
    first place of the item that has its window, unless it goes on with the run of the place before it."""
    item = np.searchsorted(q.ends, test, "right")
    order = np.lexsort((test, test_of, item))
    item, test, test_of = item[order], test[order], test_of[order]
    own = np.ones(len(item), bool)  # the first suffix of each item and range
    own[1:] = (np.diff(item) != 0) | (np.diff(test_of) != 0)
    again = np.unique(item[~own])  # items that repeat themselves
    places = np.argsort(of, kind="stable")
    low = np.searchsorted(of[places], test_of[own], "left")
    sizes = np.searchsorted(of[places], test_of[own], "right") - low
    firsts, items = test[own], item[own]
    starts = np.concatenate(([0], q.ends))
    edges = np.append(np.flatnonzero(np.diff(items, prepend=-1)), len(items))
    a = 0
    while a < len(edges) - 1:  # some items at a time, so that their places stay few
        b = a + 1
        while b < len(edges) - 1 and sizes[edges[a] : edges[b + 1]].sum() <= AT_ONCE:
            b += 1
        part = slice(edges[a], edges[b])
        i, t = np.repeat(items[part], sizes[part]), np.repeat(firsts[part], sizes[part])
        x = places[np.repeat(low[part], sizes[part]) + spread(sizes[part])]
        order = np.lexsort((at[x], i))
        i, t, p, r = i[order], t[order], at[x][order], of[x][order]
        for k in again[(again >= items[part][0]) & (again <= items[part][-1])]:
            # where the item has a window more than once, a run goes on with the suffix that follows, if it has the range
            suffix = slice(*np.searchsorted(item, [k, k + 1]))
            base = starts[k]
            range_of = dict(zip((test[suffix] - base).tolist(), test_of[suffix].tolist(), strict=True))
            lo, hi = np.searchsorted(i, [k, k + 1])
            before, now, made = -2, 0, []
            for place, first, range_ in zip(p[lo:hi].tolist(), (t[lo:hi] - base).tolist(), r[lo:hi].tolist(), strict=True):
                now = now + 1 if place == before + 1 and range_of.get(now + 1) == range_ else first
                made.append(now)
                before = place
            t[lo:hi] = np.array(made, np.int64) + base
        new = np.ones(len(p), bool)
        new[1:] = (np.diff(p) != 1) | (np.diff(t) != 1) | (np.diff(i) != 0)
        begin = np.flatnonzero(new)
        words = np.diff(np.append(begin, len(p))) - 1 + n
        yield from zip(p[begin].tolist(), i[begin].tolist(), (t[begin] - starts[i[begin]]).tolist(), words.tolist(), strict=True)
        a = b


def search(texts: list[bytes | None], q: Queries, size: int = SHARD_BYTES) -> list[tuple]:
    """Per text: words, words hit, ids of items found, longest matches with their places, ranges hit."""
    out, shard, n = [], [], 0
    for raw in texts:
        shard.append(raw)
        if (n := n + len(raw or b"")) >= size:
            out += _search(shard, q)
            shard, n = [], 0
    return out + _search(shard, q)


def _search(texts: list[bytes | None], q: Queries) -> list[tuple]:
    ids, lengths = [], []
    for raw in texts:
        found = words_of(raw)
        get = q.vocabulary.get
        lengths.append(len(found))
        ids.append(np.array([get(w, 0) for w in found] + [0], np.int32))
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    flat = np.concatenate([*ids, np.zeros(q.window, np.int32)])
    hit, base = np.zeros(len(flat) + 1, np.int32), np.concatenate(([0], ends))
    out = [[n, 0, [], [], []] for n in lengths]
    for n, at, of, test, test_of in occurrences(flat, q):
        hit[at] += 1
        hit[at + n] -= 1
        for place, i, j, words in _runs(n, at, of, test, test_of, q):
            d = int(np.searchsorted(ends, place, "right"))
            out[d][3].append({"doc_word": place - int(base[d]), "item_word": j, "n_words": words, "item_id": q.ids[i]})
    if hit.any():
        covered = np.cumsum(hit)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
        for a, b in edge.reshape(-1, 2).tolist():
            d = int(np.searchsorted(ends, a, "right"))
            off = int(ends[d - 1]) if d else 0
            out[d][4].append({"start": a - off, "end": b - off})
            out[d][1] += b - a
    for row in out:
        row[2] = sorted({m["item_id"] for m in row[3] if m["item_id"] is not None})
        row[3].sort(key=lambda m: (m["doc_word"], m["item_word"], m["n_words"], m["item_id"] is not None, m["item_id"] or ""))
    return out


_SPAN = pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))
_MATCH = pa.list_(pa.struct({"doc_word": pa.int32(), "item_word": pa.int32(), "n_words": pa.int32(), "item_id": pa.string()}))
KINDS = [pa.int64(), pa.int64(), pa.list_(pa.string()), _MATCH, _SPAN]


def _items(bench: DataFrame, text: str, item: str) -> tuple[DataFrame, int]:
    """The distinct items, and how many passes they take."""
    rows = bench.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    return rows, max(1, -(-(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // PASS_BYTES))


def _found(items: DataFrame, window: int, passes: int, k: int):
    """What the k-th pass does with a batch of texts; its share of the benchmark is at most about PASS_BYTES."""
    rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k).collect()
    held = items.sparkSession.sparkContext.broadcast(Queries(sorted(map(tuple, rows), key=lambda x: (x[0] or "", x[1])), window))

    size = SHARD_BYTES  # goes to the workers with the closure

    def found(texts: pa.Array) -> list[pa.Array]:
        rows = search(texts.cast(pa.binary()).to_pylist(), held.value, size)
        return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(KINDS)]

    return found


def _merged(hits: Column) -> Column:
    """Ranges in order, those that touch or overlap made one."""
    def add(done: Column, h: Column) -> Column:
        last = F.element_at(done, -1)
        one = F.struct(last["start"].alias("start"), F.greatest(last["end"], h["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= h["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(one))).otherwise(F.concat(done, F.array(h)))

    return F.aggregate(F.array_sort(hits), F.array().cast(HITS), add)


def find_items(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", window: int = 10, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of docs (all, if None) and n_words, n_hit, items, matches, hits of each row's whole text.

    Words are runs of ASCII letters and digits, lower-cased, and of other characters beyond ASCII. A window is `window`
    consecutive words of an item, or all words of a shorter one. hits are the ranges of words inside occurrences of
    windows, in order; matches are, of each item found, the verbatim runs with their places, each as
    long as it goes on; items the ids of items found. Null texts
    have no words; items without words are never found; an item with a null id marks words but is not listed; of items
    with equal ids one is listed. Repeated rows are judged alike. An added column replaces one of docs with its name.

    Benchmark text goes to the tasks in passes of at most PASS_BYTES; more of it takes more passes over the documents and
    gives the same rows. A single item of more than that is a pass of its own.
    """
    items, passes = _items(bench, text, item)
    if passes == 1:
        return with_results(docs, text, keep, RESULT, _found(items, window, 1, 0))
    inner = {c: f"in{i}" for i, c in enumerate(docs.columns)}  # no name of docs meets those used here
    rows = cut(docs.toDF(*inner.values()).withColumn("row", F.monotonically_increasing_id()), "documents")
    parts = [with_results(rows.select("row", inner[text]), inner[text], ["row"], RESULT, _found(items, window, passes, k)) for k in range(passes)]
    merged = reduce(DataFrame.union, parts).groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"),
        _merged(F.flatten(F.collect_list("hits"))).alias("hits"),
    )
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    added = {"n_words": "n_words", "n_hit": n_hit, "items": "items", "matches": "matches", "hits": "hits"}
    names = [c for c in docs.columns if (keep is None or c in keep) and c not in added]
    joined = rows.join(merged, "row")
    return joined.select(*[F.col(inner[c]).alias(c) for c in names], *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in added.items()])


def decontaminated(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", window: int = 10) -> DataFrame:
    """The rows of docs in which no benchmark window occurs, with their columns alone; each pass searches what the one
    before has left. Null and empty texts stay, repeated rows are judged alike, an empty benchmark leaves all rows."""
    items, passes = _items(bench, text, item)
    for k in range(passes):
        docs = rows_where(docs, text, RESULT, _found(items, window, passes, k), F.col("n_hit") == 0)
    return docs


def op8_decontamination(spark, sf_dir):
    rows = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
     dw AS (SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS x FROM (SELECT d.r, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) l WHERE len(d.w) >= l.n)),
     h AS (SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.x = iw.x),
     c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM h)) GROUP BY r),
     s AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(s.n_items, 0) AS n_items, sha256(coalesce(s.l, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)
"""
