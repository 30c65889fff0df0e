"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hash tables cuts space by ``width``-wide slabs along random Gaussian directions; a vector's cell is
the tuple of its slabs. A query visits cells of each table in order of the estimated chance that a true neighbour, whose
projections differ from the query's by Gaussian steps of the typical neighbour distance, lies there, until the chances
add up to ``mass``. The candidates of all tables are merged and ranked by exact Euclidean distance in double precision.

The number of directions follows the logarithm of the row count, so that a cell holds a bounded number of ordinary
vectors. Cells that hold more, as copies make them, are dealt into blocks of about ``block`` vectors; every block is
searched, so nothing is capped. Blocks are spread by hash over tasks, as many as the vectors ask for, and each returns its
own nearest only. Vectors are sent once a table, as bytes and in the precision they come in.

A query that met fewer than ``k`` others in its cells is searched for in all rows, so its list is exact and as long as
the table allows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, Window
from pyspark.sql.types import FloatType

from .common import Staged, spread

#: The bounded sample on which the typical neighbour distance is estimated.
SAMPLE_ROWS = 2_000
#: Bytes of vectors that a task searches, on average.
TASK_BYTES = 64_000_000


def _usable(vector: Column) -> Column:
    """Neither null, empty or zero nor with null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


class Tables:
    """The hash functions, made from a seed; the same on driver and workers."""

    def __init__(self, dim: int, tables: int, directions: int, width: float, step: float, mass: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.shape, self.width, self.step, self.mass = (tables, directions), width, step, mass
        self.a = rng.standard_normal((tables * directions, dim))
        self.b = rng.uniform(0, width, tables * directions)

    def slabs(self, x: np.ndarray) -> np.ndarray:
        """Real-valued slab positions: rows x tables x directions; a cell is their floor."""
        return ((x @ self.a.T + self.b) / self.width).reshape(len(x), *self.shape)

    @staticmethod
    def keys(cells: np.ndarray, table: int) -> np.ndarray:
        """64-bit keys of integer cells (rows x directions) of one table."""
        h = np.full(len(cells), table + 1, dtype=np.uint64)
        for column in cells.T.astype(np.int64).view(np.uint64).reshape(cells.shape[1], -1):
            h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)

    def probes(self, position: np.ndarray) -> np.ndarray:
        """Cells of one table in order of estimated chance, for a query's slab positions (one per direction)."""
        spread, home = self.step / self.width, np.floor(position)
        choices = []
        for p, h in zip(position, home, strict=True):
            reach = np.arange(-2, 3)
            edges = (h + np.append(reach, 3) - p) / spread
            chance = np.diff([0.5 * (1 + math.erf(e / math.sqrt(2))) for e in edges])
            order = np.argsort(-chance, kind="stable")
            choices.append([(float(chance[i]), int(h) + int(reach[i])) for i in order if chance[i] > 1e-4])
        start = (0,) * len(choices)
        chance_of = lambda ix: math.prod(c[i][0] for c, i in zip(choices, ix, strict=True))
        queue, out, total = [(-chance_of(start), start)], [], 0.0
        while queue and total < self.mass:
            chance, ix = heapq.heappop(queue)
            total -= chance
            out.append([c[i][1] for c, i in zip(choices, ix, strict=True)])
            last = max((k for k, i in enumerate(ix) if i), default=0)  # each combination is reached once
            for k in range(last, len(ix)):
                if ix[k] + 1 < len(choices[k]):
                    more = ix[:k] + (ix[k] + 1,) + ix[k + 1 :]
                    heapq.heappush(queue, (-chance_of(more), more))
        return np.array(out, dtype=np.int64).reshape(-1, len(choices))


def fit_tables(vectors: DataFrame, rows: int, k: int = 10, tables: int = 4, mass: float = 0.62, cell: int = 150) -> Tables | None:
    """Hash functions for vectors (vec_id, v). The typical distance of a k-th neighbour is the upper part of those seen in
    a bounded sample, with the distances of the whole table's neighbours at most as large."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()
    if not len(sample):
        return None
    dim = int(sample["v"].map(len).mode()[0])
    x = np.array([v for v in sample["v"] if len(v) == dim], dtype=np.float64)
    norm = float(np.sqrt((x**2).sum(axis=1)).mean())
    near = [np.sort(np.sqrt(((x - q) ** 2).sum(axis=1)))[min(k, len(x) - 1)] for q in x[:200]]
    step = max(float(np.quantile(near, 0.75)), 1e-9 + 1e-6 * norm)
    spread = max(float((x - x.mean(axis=0)).std(axis=0).mean()) * math.sqrt(dim), 1e-9)
    width = 2.2 * spread
    directions = max(2, round(math.log(max(rows / cell, 2)) / math.log(2.4)))
    return Tables(dim, tables, directions, width, step, mass)


def _packed(b, dim: int, kind: str):
    """Of a batch (vec_id, v: lists), the ids and vectors of length ``dim``, these also as an array of bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    b = b.filter(pc.equal(pc.list_value_length(b.column("v")), dim))
    x = np.ascontiguousarray(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), dtype=kind)
    coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.itemsize * dim), len(x), [None, pa.py_buffer(x.tobytes())])
    return b.column("vec_id"), x.astype(np.float64), coded.cast(pa.binary())


def nearest(vectors: DataFrame, queries: Column, k: int = 10, block: int = 2_000, **fit) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (vec_id, embedding) where ``queries`` holds, the k
    nearest others found, nearest first, ties to the smaller vec_id; ``score`` is the Euclidean distance.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part; nor do those of another
    length than most. A null vec_id takes no part either. Rows that repeat a vec_id are candidates each, but a vec_id is
    returned once, at its smallest distance. With fewer candidates than k, all are returned. Other columns are ignored; an
    empty table gives an empty result.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    usable = vectors.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)  # sent as they are, compared in double
    kind, element = ("<f4", "float") if single else ("<f8", "double")
    rows = spread(usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{element}>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")))
    total = rows.count()
    hashed = fit_tables(rows.select("vec_id", "v"), total, k, **fit) if total else None
    if hashed is None:
        return spark.createDataFrame([], schema)
    staged, dim, n_tables = Staged(spark), hashed.a.shape[1], hashed.shape[0]
    own = rows.select("vec_id", "v")

    def keys_of(x: np.ndarray) -> list[np.ndarray]:
        cells = np.floor(hashed.slabs(x))
        return [hashed.keys(cells[:, t], t) for t in range(n_tables)]

    def count_cells(batches):
        for b in batches:
            keys, n = np.unique(np.concatenate(keys_of(_packed(b, dim, kind)[1])), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    def hash_rows(batches):
        for b in batches:
            ids, x, coded = _packed(b, dim, kind)
            for keys in keys_of(x):
                yield pa.RecordBatch.from_arrays([pa.array(keys), ids, coded], ["key", "vec_id", "v"])

    def hash_queries(batches):
        for b in batches:
            ids, x, coded = _packed(b, dim, kind)
            probes = [np.unique(np.concatenate([hashed.keys(hashed.probes(p[t]), t) for t in range(n_tables)])) for p in hashed.slabs(x)]
            yield pa.RecordBatch.from_arrays([ids, coded, pa.array(probes, pa.list_(pa.int64()))], ["query_id", "v", "keys"])

    # cells of more than a block's vectors, written first: their number is known when the vectors are sent
    counts = own.mapInArrow(count_cells, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > block)
    large = staged.keep(counts.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * n_tables * dim * np.dtype(kind).itemsize / TASK_BYTES))
    task = lambda: F.pmod(F.xxhash64("key", "block"), F.lit(tasks)).cast("int").alias("task")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = own.mapInArrow(hash_rows, "key long, vec_id long, v binary").join(large, "key", "left").withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
    asked = rows.where("asks").select("vec_id", "v").mapInArrow(hash_queries, "query_id long, v binary, keys array<long>")
    wanted = (
        asked.select("query_id", "v", F.explode("keys").alias("key")).join(large, "key", "left")
        .select("query_id", "v", "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    )

    def matrix(column) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)

    def search(held, asking):
        out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
        if len(held) and len(asking):
            key, part, ids, v = held.column("key").to_numpy(), held.column("block").to_numpy(), held.column("vec_id").to_numpy(), matrix(held.column("v"))
            order = np.lexsort((part, key))
            key, part, ids, v = key[order], part[order], ids[order], v[order]
            starts = np.flatnonzero(np.append(True, (np.diff(key) != 0) | (np.diff(part) != 0)))
            where = dict(zip(zip(key[starts].tolist(), part[starts].tolist()), zip(starts.tolist(), [*starts[1:].tolist(), len(key)])))
            for query_id, q, cells in zip(asking.column("query_id").to_pylist(), matrix(asking.column("v")), asking.column("cells").to_pylist()):
                spans = [where[c["key"], c["block"]] for c in cells if (c["key"], c["block"]) in where]
                if spans:
                    at = np.concatenate([np.arange(s, e) for s, e in spans])
                    near_ids, near = _closest(ids[at], v[at], q, query_id, k)
                    out.append((np.full(len(near), query_id), near_ids, near))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    def found(held: DataFrame, asking: DataFrame) -> DataFrame:
        """Vectors (key, block, vec_id, v) and queries (query_id, v, key, block) meet by task."""
        lists = asking.select("*", task()).groupBy("task", "query_id").agg(F.first("v").alias("v"), F.collect_list(F.struct("key", "block")).alias("cells"))
        return held.select("key", "block", "vec_id", "v", task()).groupBy("task").cogroup(lists.groupBy("task")).applyInArrow(search, "query_id long, vec_id long, score double")

    def ranked(rows: DataFrame) -> DataFrame:
        merged = rows.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # once, if several tables had it
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    probed = staged.keep(ranked(found(dealt, wanted)))
    full = probed.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = staged.keep(rows.where(F.col("asks") & (F.size("v") == dim)).select("vec_id", "v").join(full, "vec_id", "left_anti"))
    if short.isEmpty():
        return probed
    parts = math.ceil(total / block)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block")

    def code(batches):
        for b in batches:
            ids, _, coded = _packed(b, dim, kind)
            yield pa.RecordBatch.from_arrays([ids, coded], ["vec_id", "v"])

    coded = lambda df: df.mapInArrow(code, "vec_id long, v binary")
    asking = coded(short).select(F.col("vec_id").alias("query_id"), "v", F.lit(0).cast("long").alias("key"), everywhere)
    held = coded(own).select(F.lit(0).cast("long").alias("key"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("block"), "vec_id", "v")
    return ranked(probed.select("query_id", "vec_id", "score").unionByName(found(held, asking)))


def _closest(ids: np.ndarray, v: np.ndarray, q: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest distinct ids, ties to the smaller, without the query's own."""
    distance = np.sqrt(((v - q) ** 2).sum(axis=1))
    distance[ids == query_id] = np.inf
    if len(ids) > 4 * k:  # all that are no farther than the k-th distinct id can be
        kth = np.partition(distance, 3 * k)[3 * k]
        few = distance <= kth
        if len(np.unique(ids[few])) > k:
            ids, distance = ids[few], distance[few]
    order = np.lexsort((ids, distance))
    ids, distance = ids[order], distance[order]
    first = np.sort(np.unique(ids, return_index=True)[1])
    first = first[np.isfinite(distance[first])][:k]
    return ids[first], distance[first]
