"""Operator 11: centroid clustering with a distance matrix that is kept and changed, not computed anew."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import cut, discard, table

K, ROUNDS, DIMS, SCALE, SEED = 16, 3, 64, 64, 1
#: Components beyond this magnitude are too far for distances in 64 bits: such vectors get no cluster.
FAR = 1 << 27
#: Sums of distances are kept in two parts, so that no task's sum leaves 64 bits.
HALF = 31

#: Components of all centroids: they are on the driver and in every task.
MOST = 1 << 20


def _state(key: T.DataType) -> T.StructType:
    """A row is a vector (v its components, null if it is too far; dots its products with all centroids; in the last table
    its distance), or what a task sums up over its vectors of one cluster (v null, n not). v and dots are packed."""
    kinds = [("key", key), ("v", T.BinaryType()), ("dots", T.BinaryType()), ("cluster", T.IntegerType()), ("distance", T.LongType()), ("n", T.LongType()), ("sums", T.ArrayType(T.LongType()))]
    return T.StructType([T.StructField(a, b) for a, b in kinds])


def _packed(rows: np.ndarray, none: np.ndarray | None = None) -> pa.Array:
    """Rows of a matrix of whole numbers as binary values, in the least width that holds them; null where none holds."""
    most = max(int(rows.max(initial=0)), -int(rows.min(initial=0)) - 1)
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    data = np.ascontiguousarray(rows, np.dtype(kind).newbyteorder("<"))
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (data.itemsize * rows.shape[1])
    valid = None if none is None else pa.py_buffer(np.packbits(~none, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), len(rows), [valid, pa.py_buffer(ends), pa.py_buffer(data)])


def _ordered(rows: np.ndarray, none: np.ndarray) -> pa.Array:
    """The same in a width and form whose bytes sort as the rows do."""
    return pa.array([None if gone else row.tobytes() for row, gone in zip((rows + (1 << 31)).astype(">u4"), none, strict=True)], pa.binary())


def _unpacked(column: pa.Array, size: int) -> np.ndarray:
    """The matrix of packed rows of `size` numbers; tasks may have packed theirs in different widths."""
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    out = np.empty((len(column), size), np.int64)
    for n in np.unique(lengths):
        own = lengths == n
        part = column if own.all() else column.filter(pa.array(own))
        offsets = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1]
        raw = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        out[own] = raw.view(f"<i{n // size}").reshape(-1, size)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b in whole numbers: in floats where these are exact, as they are many times faster."""
    if a.shape[-1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _integers(vectors: DataFrame, key: str, vector: str, dims: int, scale: int, packed: Callable[[np.ndarray, np.ndarray], pa.Array] = _packed, more: str | None = None) -> DataFrame:
    """(key, v; or h, the column `more`, and v): vectors of exactly dims finite components as packed integers floor(scale * x); v is null where one is too far."""
    name = "h" if more else "key"
    schema = T.StructType([T.StructField(name, vectors.schema[more or key].dataType), T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sized = b.column(1).value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dims
            b = b.filter(pa.array(sized))
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # a null is NaN here
            fine = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                x = np.floor(scale * x[fine])
            near = (np.abs(x) <= FAR).all(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(fine)), packed(np.where(near[:, None], x, 0).astype(np.int64), ~near)], names=schema.names)

    kind = vectors.schema[vector].dataType
    given = F.col(f"`{vector}`") if kind in (T.ArrayType(T.FloatType()), T.ArrayType(T.DoubleType())) else F.col(f"`{vector}`").cast("array<double>")
    return vectors.select(F.col(f"`{more or key}`").alias(name), given.alias("v")).mapInArrow(run, schema)


def _pass(rows: DataFrame, schema: T.StructType, dots_of: Callable[[np.ndarray, pa.RecordBatch], np.ndarray], norms: np.ndarray, dims: int, last: bool) -> DataFrame:
    """One pass over the vectors: their products with the centroids by dots_of, the nearest centroid (the smaller number of
    equal ones), and behind a task's vectors its sums by cluster: of components, or in the last pass of distances."""
    arrow, k = to_arrow_schema(schema), len(norms)

    def made(rows_: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows_, f.type)) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, 2 if last else dims), np.int64)
        for b in batches:
            if b.column(1).null_count:
                far, b = b.filter(b.column(1).is_null()), b.filter(b.column(1).is_valid())
                yield made(far.num_rows, key=far.column(0))
            if not b.num_rows:
                continue
            v = _unpacked(b.column(1), dims)
            dots = dots_of(v, b)
            score = norms - 2 * dots
            nearest = score.argmin(axis=1)
            counts += np.bincount(nearest, minlength=k)
            cluster = pa.array(nearest.astype(np.int32))
            if last:
                distance = (v * v).sum(axis=1) + score[np.arange(len(v)), nearest]
                parts = np.stack((distance >> HALF, distance & ((1 << HALF) - 1)), axis=1)
                yield made(len(v), key=b.column(0), cluster=cluster, distance=pa.array(distance))
            else:
                parts = v
                yield made(len(v), key=b.column(0), v=b.column(1), dots=_packed(dots))
            sums += _product((nearest == np.arange(k)[:, None]).astype(np.int64), parts)
        if counts.any():
            lists = pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * sums.shape[1], pa.int32()), pa.array(sums.reshape(-1)))
            yield made(k, cluster=pa.array(np.arange(k, dtype=np.int32)), n=pa.array(counts), sums=lists)

    return rows.mapInArrow(run, schema)


def _totals(state: DataFrame, size: int) -> dict[int, tuple[int, list[int]]]:
    """By cluster the number of vectors and their sums, of the tasks' sums: k rows of `size` numbers, whatever the input."""
    exact = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    rows = state.where("n > 0").groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(size)]) for r in rows}


def _norms(centroids: list[list[int]]) -> np.ndarray:
    return np.array([sum(x * x for x in c) for c in centroids], np.int64)


def cluster_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[dict]]:
    """(rows, clusters): key, cluster and distance of every vector that is kept, and of each cluster its centroid, size and
    inertia.

    Vectors of exactly dims components, none of them null or not finite, are kept; components become floor(scale * x).
    Centroids start as the k vectors with the least sha256 of seed and key (then by components) and are replaced after each
    round by the floor of their vectors' mean. A table keeps each vector's exact integer products with all centroids; a round
    changes them by the components in which a centroid has changed, takes the nearest and writes the next table, from which an
    executor's loss costs no earlier round. Beside it a task writes its sums by cluster, so nothing but k rows a task is shuffled,
    and k centroids reach the driver, at any size and however many vectors are equal or fall to one centroid.

    Repeated rows are vectors each; a null key counts as the empty text. With fewer than k vectors each starts a centroid;
    without any, both results are empty. A vector with a component beyond FAR has a row without cluster and distance and
    takes part in nothing else. An inertia that a long cannot hold is null in the query, and exact here.
    """
    name = key
    vectors, key, vector = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector")), "key", "vector"
    given, schema = _integers(vectors, key, vector, dims, scale), _state(vectors.schema[key].dataType)
    if k * dims > MOST:
        raise ValueError(f"more than {MOST} components of centroids")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)

    def first(rows: DataFrame) -> list[list[int]]:
        """The k vectors of least hash: no more than k rows of a task reach the driver, however many have one hash."""
        told = _integers(rows.withColumn("_h", drawn), key, vector, dims, scale, _ordered, "_h").where("v IS NOT NULL")
        return [(np.frombuffer(r["v"], ">u4").astype(np.int64) - (1 << 31)).tolist() for r in told.orderBy("h", "v").limit(k).collect()]

    # few hashes are looked at with their vectors; all, where too many of these are not kept
    few = vectors.select(drawn.alias("h")).orderBy("h").limit(4 * k).agg(F.max("h")).first()[0]
    centroids = first(vectors.where(drawn <= few)) if few else []
    if few and len(centroids) < k:
        centroids = first(vectors)
    if not centroids:
        rows = given.select(F.col("key").alias(name), F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
        return rows, []

    start = np.array(centroids, np.int64).T
    held, dots_of = given, lambda v, b: _product(v, start)
    state = None
    for r in range(rounds + 1):
        now = cut(_pass(held, schema, dots_of, _norms(centroids), dims, last=r == rounds), "vectors")
        if state is not None:
            discard(state)
        state, held = now, now.where("n IS NULL")
        if r == rounds:
            break
        held = held.select("key", "v", "dots")
        totals = _totals(state, dims)
        after = [[s // totals[c][0] for s in totals[c][1]] if c in totals else old for c, old in enumerate(centroids)]
        change = np.array(after, np.int64) - np.array(centroids, np.int64)
        moved, at = np.flatnonzero(change.any(axis=1)), np.flatnonzero(change.any(axis=0))
        by = change[np.ix_(moved, at)].T.copy()  # what has changed: some components of some centroids

        def dots_of(v: np.ndarray, b: pa.RecordBatch, k_now: int = len(after), moved: np.ndarray = moved, at: np.ndarray = at, by: np.ndarray = by) -> np.ndarray:
            dots = _unpacked(b.column(2), k_now)
            dots[:, moved] += _product(v[:, at], by)
            return dots

        centroids = after
    totals = _totals(state, 2)
    inertia = {c: (hi << HALF) + lo for c, (_, (hi, lo)) in totals.items()}
    clusters = [{"cluster": c, "centroid": x, "size": totals[c][0] if c in totals else 0, "inertia": inertia.get(c, 0)} for c, x in enumerate(centroids)]
    return held.select(F.col("key").alias(name), "cluster", "distance"), clusters


def op11_centroids(spark, sf_dir):
    rows, clusters = cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    as_long = lambda x: F.lit(x if x < 1 << 63 else None).cast("long")
    of = lambda made, kind: F.element_at(F.array(*[made(c) for c in clusters]), F.col("cluster") + 1) if clusters else F.lit(None).cast(kind)
    digest = lambda c: F.lit(hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest())
    inertia = sum(c["inertia"] for c in clusters)
    return rows.select("vec_id", "cluster", "distance", of(lambda c: as_long(c["inertia"]), "long").alias("cluster_inertia"), as_long(inertia).alias("inertia"), of(digest, "string").alias("centroid_sha256"))


def _sql(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same with all distances computed anew in each round."""
    finite = f"len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims} AND len(embedding) = {dims}"
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {finite})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM v ORDER BY h, v LIMIT {k}))",
    ]
    far = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT i, vec_id, v, k, d FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d, k) AS o FROM (SELECT i, vec_id, v, k, CAST({far} AS BIGINT) AS d FROM v, c{r})) WHERE o = 1)")
        if r < rounds:
            parts.append(f"e{r} AS (SELECT k, unnest(v) AS x, unnest(range({dims})) AS j FROM a{r})")
            parts.append(f"s{r} AS (SELECT k, j, sum(x) AS s, count(*) AS n FROM e{r} GROUP BY k, j)")
            parts.append(f"m{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{r} GROUP BY k)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k)")
    last = f"SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"
    return "WITH " + ",\n".join(parts) + "\n" + last


SQL = _sql()
