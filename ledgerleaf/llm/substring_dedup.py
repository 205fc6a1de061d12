"""Substring dedup by level-wise doubling of repeated word windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, join_small, table
from .words import word_hashes

#: Bytes of text that one group of documents holds, and of hashes that one bucket of them gets.
BLOCK_BYTES, BUCKET_BYTES = 12 << 20, 24 << 20
#: Bytes of text whose words are looked at together.
CHUNK_BYTES = 1 << 18
LAST = np.iinfo(np.int64).max
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(29), np.uint64(32))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a window from those of its two parts."""
    h = a * _MIX[0] + b
    h = (h ^ (h >> _MIX[2])) * _MIX[1]
    return h ^ (h >> _MIX[3])


def names(words: np.ndarray, n: int) -> np.ndarray:
    """The names of all windows of n words: from those of half the length, twice as long at each step."""
    if n == 1:
        return words
    if len(words) < n:
        return words[:0]
    a, half = names(words, n // 2), n // 2
    two = _pair(a[: len(a) - half], a[half:])
    return two if n % 2 == 0 else _pair(two[: len(words) - n + 1], words[n - 1 :])


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """The least or greatest of each n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x, have = pick(x[: len(x) - step], x[step:]), have + step
    return x


def anchors(x: np.ndarray, n: int, alive: np.ndarray) -> np.ndarray:
    """Where in x the least name of some window of n names that is alive stands. alive: one flag for each window."""
    told = np.where(alive, _sliding(x, n, np.minimum), np.uint64(0))
    edge = np.zeros(n - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate((edge, told, edge)), n, np.maximum) == x)


def _member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which x are among the sorted values `of`."""
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x if len(of) else np.zeros(len(x), bool)


def _texts(t: pa.Table) -> list[tuple[int | None, bytes, int]]:
    """(key, text, copies) of a block's documents in key order, null keys last."""
    rows = zip(t["key"].to_pylist(), t["text"].cast(pa.binary()).to_pylist(), t["many"].to_pylist(), strict=True)
    return sorted(((k, raw or b"", n) for k, raw, n in rows), key=lambda x: LAST if x[0] is None else x[0])


def _chunks(texts: list[tuple[int | None, bytes, int]], window: int, size: int) -> Iterator[tuple[list[bytes], int, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of about `size` bytes at a time: (these, number of the first, hashes of all their words, places of their ends
    among these, whether a window that starts at a word lies in one text)."""
    at = 0
    while at < len(texts):
        to, n = at, 0
        while to < len(texts) and (to == at or n + len(texts[to][1]) <= size):
            n, to = n + len(texts[to][1]), to + 1
        hashes, ends = word_hashes(own := [raw for _, raw, _ in texts[at:to]])
        room = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(hashes))
        yield own, at, hashes, ends, (room >= window)[: max(0, len(hashes) - window + 1)]
        at = to


def _flat(lists: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(lists) if lists else np.zeros(0, kind)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _values(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _by_bucket(block: int, n_buckets: int, where: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row for each bucket of a block: the columns' values that belong there as lists."""
    bucket = (where >> np.uint64(33)).astype(np.int64) % n_buckets
    order = np.argsort(bucket, kind="stable")
    ids, at = np.unique(bucket[order], return_index=True)
    ends = pa.array(np.append(at, len(order)).astype(np.int32))
    lists = {c: pa.ListArray.from_arrays(ends, _signed(v[order]) if v.dtype != np.bool_ else pa.array(v[order])) for c, v in columns.items()}
    return pa.table({"bucket": pa.array(ids), "block": pa.array(np.full(len(ids), block))} | lists)


def _part(t: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column, and the row of each."""
    lengths = np.array([len(x) if x.is_valid else 0 for x in t[column]], np.int64)
    return t[column].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(t)), lengths)


def _lists(values: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
    """values (in row order) as one list for each of n rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def repeated_words(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = 20, seed_words: int = 5, with_text: bool = False) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_sha256, spans (ranges of removed words) and, on demand, kept_text.

    A word goes if it lies in a window of `window` words whose words also start at an earlier place: a smaller key, or the
    same key and an earlier start. Windows are judged on the input. Keys are whole numbers; null keys come last and count
    as one key; rows with one key and equal starts are no earlier than each other, so both stay. Null texts have no words,
    short ones no window. Other columns are not read.

    window = seed_words * 2 ** k. At each length but the last, the least name of the windows inside each candidate (its
    anchor, the same in all copies of it) is counted over the corpus; candidates whose anchor stands alone are done, the
    others are extended to twice the length, until at `window` words each one's first place is found. There a window is known
    by 128 bits, two independent names of all its words, so that equal names mean equal words.
    Documents are dealt once to blocks of bounded size by a hash of key and text, and this exchange is used by all levels.
    A block sends each distinct name once, so the most frequent passage takes one entry per block. Wholly equal rows that
    fill a quarter of a block are judged once, with their number.
    """
    chunk, levels = CHUNK_BYTES, [seed_words]  # chunk goes to the workers with the closures
    while levels[-1] < window:
        levels.append(2 * levels[-1])
    if levels[-1] != window or len(levels) < 2:
        raise ValueError("window must be seed_words times a power of two")
    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.lit(1).cast("long").alias("many"), F.xxhash64(key, text).alias("h"))
    sizes = cut(given.select("h", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")).groupBy("h").agg(F.sum("n").alias("n"), F.count("*").alias("c")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = cut(sizes.where((F.col("c") > 1) & (F.col("n") > BLOCK_BYTES // 4)).select("h"), "hot")
    if several := bool(hot.take(1)):
        once = join_small(given, hot, ["h"], "left_semi").groupBy("key", "text", "h").agg(F.sum("many").alias("many"))
        given = join_small(given, hot, ["h"], "left_anti").select("key", "text", "many", "h").union(once.select("key", "text", "many", "h"))
    n_blocks, n_names, n_firsts = max(1, -(-total // BLOCK_BYTES)), max(32, total // (4 * BUCKET_BYTES)), max(32, 4 * total // BUCKET_BYTES)
    block = F.pmod("h", F.lit(n_blocks)).alias("block")
    keyed = given.select(block, "key", "text", "many").repartition(min(n_blocks, 100_000), "block").groupBy("block")

    def alive(hashes: np.ndarray, fits: np.ndarray, length: int, found: np.ndarray) -> np.ndarray:
        return fits & _member(_sliding(names(hashes, length), window - length + 1, np.minimum), found) if len(fits) else fits

    def level_names(length: int, before: int | None):
        def send(docs: pa.Table, found: pa.Table) -> pa.Table:
            known = np.unique(_values(found["h"])) if len(found) else np.zeros(0, np.uint64)
            out = []
            for _, _, hashes, _, fits in _chunks(_texts(docs), window, chunk):
                live = fits if before is None else alive(hashes, fits, before, known)
                if live.any():
                    x = names(hashes, length)
                    out.append(x[anchors(x, window - length + 1, live)])
            distinct, many = np.unique(_flat(out, np.uint64), return_counts=True)
            block = docs["block"][0].as_py() if len(docs) else 0
            return _by_bucket(block, n_names, distinct, {"h": distinct, "twice": many > 1})

        def send_all(docs: pa.Table) -> pa.Table:
            return send(docs, docs.slice(0, 0))

        return send_all if before is None else send

    def repeated(t: pa.Table) -> pa.Table:
        h, row = _part(t, "h")
        twice, _ = _part(t, "twice")
        own, at, many = np.unique(h, return_inverse=True, return_counts=True)
        again = (many > 1) | (np.bincount(at, weights=twice, minlength=len(own)) > 0)
        kept = again[at]
        return pa.table({"block": t["block"], "h": _lists(h[kept], row[kept], len(t))})

    def windows(docs: pa.Table, found: pa.Table) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a block: its texts and their numbers of words; of the windows that are candidates: number of the text, start, the
        names of all its words by two independent families of hashes, and the place of the first equal one of the block, in
        order of keys and starts."""
        known = np.unique(_values(found["h"])) if len(found) else np.zeros(0, np.uint64)
        texts, number, start, one, two = _texts(docs), [], [], [], []
        words = []
        for own, first, hashes, ends, fits in _chunks(texts, window, chunk):
            at = np.flatnonzero(alive(hashes, fits, levels[-2], known))
            of = np.searchsorted(ends, at, "right")
            words.append(np.diff(ends, prepend=0))
            number.append(first + of)
            start.append(at - np.concatenate(([0], ends))[of])
            one.append(names(hashes, window)[at] if len(at) else hashes[:0])
            # the second family only for the texts that have candidates
            some, place = np.unique(of, return_inverse=True)
            again, stops = word_hashes([own[i] for i in some], 1) if len(some) else (hashes[:0], ends[:0])
            two.append(names(again, window)[start[-1] + np.concatenate(([0], stops))[place]])
        number, start, one, two = _flat(number, np.int64), _flat(start, np.int64), _flat(one, np.uint64), _flat(two, np.uint64)
        key = np.array([LAST if k is None else k for k, _, _ in texts], np.int64)[number] if len(number) else np.zeros(0, np.int64)
        order = np.lexsort((start, key, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
        return texts, _flat(words, np.int64), number, start, np.stack((one, two)), key, first

    def send_windows(docs: pa.Table, found: pa.Table) -> pa.Table:
        _, _, _, start, (one, two), key, first = windows(docs, found)
        own = np.flatnonzero(first == np.arange(len(first)))
        block = docs["block"][0].as_py() if len(docs) else 0
        return _by_bucket(block, n_firsts, _pair(one[own], two[own]), {"one": one[own], "two": two[own], "key": key[own], "start": start[own]})

    def later(t: pa.Table) -> pa.Table:
        (one, row), two, key, start = _part(t, "one"), _part(t, "two")[0], _part(t, "key")[0], _part(t, "start")[0]
        order = np.lexsort((start, key, two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
        gone = (key != key[first]) | (start != start[first])
        return pa.table({"block": t["block"], "one": _lists(one[gone], row[gone], len(t)), "two": _lists(two[gone], row[gone], len(t))})

    def clean(docs: pa.Table, found: pa.Table) -> pa.Table:
        """found: rows with h (repeated names of the level before) and rows with one and two (windows first elsewhere)."""
        texts, words, number, start, (one, two), key, first = windows(docs, found)
        a, b = _values(found["one"]), _values(found["two"])
        gone = _in_pairs(one, two, a, b) | (key[first] != key) | (start[first] != start)
        number, start = number[gone], start[gone]
        out = {c: [] for c in ("key", "n_words", "n_removed", "kept_sha256", "spans", "kept_text", "many")}
        at = np.searchsorted(number, np.arange(len(texts) + 1))
        for i, (k, raw, many) in enumerate(texts):
            left, spans, removed = raw.split(), [], 0
            if len(places := start[at[i] : at[i + 1]]):
                new = np.flatnonzero(np.diff(places, prepend=-window - 1) > window)  # windows that touch make one range
                begin, end = places[new], places[np.append(new[1:], len(places)) - 1] + window
                spans, removed = [{"start": int(x), "end": int(y)} for x, y in zip(begin, end, strict=True)], int((end - begin).sum())
                for s in reversed(spans):
                    del left[s["start"] : s["end"]]
            left = b" ".join(left)
            for c, v in zip(out, (k, int(words[i]), removed, hashlib.sha256(left).hexdigest(), spans, left.decode() if with_text else None, many), strict=True):
                out[c].append(v)
        span = pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
        return pa.table([pa.array(out["key"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()), pa.array(out["spans"], span), pa.array(out["kept_text"], pa.string()), pa.array(out["many"], pa.int64())], names=list(out))

    found = None
    for length, before in zip(levels[:-1], [None, *levels], strict=False):
        send = level_names(length, before)
        kind = "bucket long, block long, h array<long>, twice array<boolean>"
        sent = (keyed if found is None else keyed.cogroup(found.groupBy("block"))).applyInArrow(send, kind)
        found = sent.groupBy("bucket").applyInArrow(repeated, "block long, h array<long>")
    firsts = keyed.cogroup(found.groupBy("block")).applyInArrow(send_windows, "bucket long, block long, one array<long>, two array<long>, key array<long>, start array<long>")
    gone = firsts.groupBy("bucket").applyInArrow(later, "block long, one array<long>, two array<long>")
    empty = F.array().cast("array<long>")
    replies = found.select("block", "h", empty.alias("one"), empty.alias("two")).union(gone.select("block", empty, "one", "two"))
    out = keyed.cogroup(replies.groupBy("block")).applyInArrow(clean, "key long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>, kept_text string, many long")
    if several:
        out = out.withColumn("many", F.explode(F.sequence(F.lit(1).cast("long"), "many")))
    return out.drop("many", *(["kept_text"] if not with_text else [])).withColumnRenamed("key", key)


def _in_pairs(one: np.ndarray, two: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which (one, two) are among the pairs (a, b)."""
    if not len(a) or not len(one):
        return np.zeros(len(one), bool)
    names_a, at = np.unique(np.concatenate((a, one)), return_inverse=True)
    names_b, bt = np.unique(np.concatenate((b, two)), return_inverse=True)
    code = at.astype(np.int64) * len(names_b) + bt
    return np.isin(code[len(a) :], code[: len(a)])


def op6_substring_dedup(spark, sf_dir):
    return repeated_words(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     x AS (SELECT r, doc_id, p, array_to_string(w[p : p + 19], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
     f AS (SELECT r, p, rank() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST, p) AS k FROM x),
     g AS (SELECT DISTINCT r, unnest(range(p, p + 20)) AS q FROM f WHERE k > 1),
     k AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS q FROM d),
     j AS (SELECT k.r, string_agg(k.v, ' ' ORDER BY k.q) AS t, count(*) AS c FROM k ANTI JOIN g ON k.r = g.r AND k.q = g.q GROUP BY k.r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(j.c, 0) AS BIGINT) AS n_removed, sha256(coalesce(j.t, '')) AS kept_sha256
FROM d LEFT JOIN j USING (r)
"""
