"""Approximate nearest neighbours by a permutation index (operator 9).

Reference points (pivots) are drawn once per vector length from a bounded sample of distinct
vectors, about PIVOTS_PER_ROOT * sqrt(rows) of them. A vector is described by its nearest
pivots in order. Each row is posted in the inverted list of its nearest pivot, with its whole
permutation; lists are laid into shards of bounded size, neighbouring pivots together, and a
list longer than a shard is dealt over several. A query walks the lists of its own nearest
``probes`` pivots and is sent to the shards that hold them, nowhere else. There rows are
ranked by footrule distance, and those within the query's limit, ties included, are reranked
by exact cosine in double precision.

``probes`` and the limit are calibrated on the sample, against brute force within it: so many
lists, and such a share of footrule distances, that TARGET of the true neighbours are reached
by each. Both belong to the query, not to a shard, so results do not depend on how lists are
dealt. The full table is denser than the sample, so its true neighbours lie nearer and recall
is higher. On clustered vectors a few lists do; vectors without clusters need most of them,
and then the search is all queries against all rows, in blocks. A query that gets fewer than
``k`` rows is held against every row of its length in a second pass, so short results are
always complete.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part; vectors of different length are no candidates of each other; ties go to the smaller
vec_id; rows with the same vec_id as the query are not its candidates; equal rows count once;
different vectors under one query id are each a query; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Pivots: this many times the square root of the rows, within the bounds.
PIVOTS_PER_ROOT = 4
PIVOTS_LEAST, PIVOTS_MOST = 64, 1024
#: A permutation holds one pivot in so many.
SHARE = 8
#: No two pivots have this cosine or more, so a dense group has few of them and does not fill its rows' lists with pivots whose order is noise.
PIVOT_COSINE = 0.8
#: Share of true neighbours in the sample that the probed lists reach, and that the footrule limit keeps.
TARGET = 0.995
SEED = 9
#: Bounds: rows of a shard, queries of a block, rows of the sample that fits the index, sample rows that serve as queries.
SHARD = 4096
QUERY_BLOCK = 8192
SAMPLE = 4096
CALIBRATE = 512


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and embedding of the vectors that take part: some non-zero component, all finite."""
    x = F.col(vec_col).cast("array<double>")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    fine = F.coalesce((F.size(x) > 0) & ~F.exists(x, bad) & F.exists(x, lambda v: v != 0), F.lit(False))
    return vectors.filter(fine & F.col(id_col).isNotNull()).withColumn(vec_col, x)


def by_length(col: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and matrix of the rows of a list column, for each length."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes = np.asarray(pc.list_value_length(col), np.int64)
    flat, starts = np.asarray(col.flatten(), np.float64), np.concatenate(([0], np.cumsum(sizes)))[:-1]
    out = []
    for d in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == d)
        out.append((d, at, flat.reshape(-1, d) if len(at) == len(sizes) else flat[starts[at][:, None] + np.arange(d)]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, safe for very large and small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivot_count(n: int) -> int:
    """Pivots for a table of n rows."""
    return int(min(PIVOTS_MOST, max(PIVOTS_LEAST, PIVOTS_PER_ROOT * n**0.5)))


def sample_of(vectors: DataFrame, seed: int = SEED, bound: int = SAMPLE, vec_col: str = "embedding") -> dict[int, np.ndarray]:
    """Unit vectors by length, shuffled: the first ``bound`` distinct vectors by hash order; only hashes are shuffled to find them."""
    hashed = vectors.select(F.xxhash64(vec_col, F.lit(seed)).alias("h"), F.col(vec_col).alias("v"))
    first = hashed.select("h").distinct().orderBy("h").limit(bound)
    found = hashed.join(F.broadcast(first), "h").groupBy("h").agg(F.min("v").alias("v")).orderBy("h").toArrow().column("v")  # at most ``bound`` rows
    rng = np.random.default_rng(seed)
    out = {}
    for d, _, x in by_length(found) if len(found) else []:
        x = np.unique(unit(x), axis=0)
        out[d] = x[rng.permutation(len(x))]
    return out


def thinned(x: np.ndarray, n: int, cosine: float = PIVOT_COSINE) -> list[int]:
    """Places of the first n unit vectors, leaving out those with ``cosine`` or more to one before."""
    kept, free = [], np.ones(len(x), bool)
    while len(kept) < n and free.any():
        kept.append(int(free.argmax()))
        free &= x @ x[kept[-1]] < cosine
        free[kept[-1]] = False
    return kept


def orders(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each row of unit vectors, nearest first."""
    sims = x @ pivots.T
    k = min(nearest, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < sims.shape[1] else np.tile(np.arange(k), (len(x), 1))
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(sims, top, axis=1), axis=1, kind="stable"), axis=1).astype(np.int16)


def side_by_side(points: np.ndarray) -> list[int]:
    """An order of the pivots in which neighbours lie together: halved along their leading direction, again and again."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= 4:
            out += part.tolist()
            continue
        x = points[part] - points[part].mean(axis=0)
        order = np.argsort(x @ np.linalg.eigh(x.T @ x)[1][:, -1], kind="stable")
        todo += [part[order[len(part) // 2 :]], part[order[: len(part) // 2]]]
    return out


class Inverted:
    """Pivot inverted files of some rows: for each pivot, the weight (k - rank, 0 if absent) of each row."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        self.k = order.shape[1]
        weight = np.arange(self.k, 0, -1, dtype=np.int16)
        files = np.zeros((len(order), n_pivots), np.int16)
        np.put_along_axis(files, order.astype(np.int64), np.broadcast_to(weight, order.shape), axis=1)
        self.files, self.weight = np.ascontiguousarray(files.T), weight[:, None]

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Footrule distance from a query's pivots to every row; an absent pivot has rank k."""
        # |i - j| summed over pivots on either side is k (k + 1) less twice the smaller weight of each.
        both = np.minimum(self.files[query], self.weight).sum(axis=0, dtype=np.int32)
        return self.k * (self.k + 1) - 2 * both


class Index:
    """Pivots of one vector length, with the calibrated number of lists and share of distances."""

    def __init__(self, sample: np.ndarray, n: int, k: int, target: float = TARGET):
        at = thinned(sample, pivot_count(n))
        self.points = sample[at]
        self.nearest = max(1, min(len(self.points), max(8, pivot_count(n) // SHARE)))
        self.probes, self.keep = len(self.points), 1.0
        # Pivots lie in their own lists at no distance: only other rows tell what a list or a limit reaches.
        rest = np.delete(sample, at, axis=0)
        self.sample = Inverted(orders(rest if len(rest) else sample, self.points, self.nearest), len(self.points))
        if len(rest) > k + 1:
            sample = rest
            asks = sample[:CALIBRATE]
            close = asks @ sample.T
            close[np.arange(len(asks)), np.arange(len(asks))] = -2
            near = np.argpartition(-close, k, axis=1)[:, :k]
            order, rank = orders(sample, self.points, self.nearest), np.empty((len(asks), len(self.points)), np.int64)
            np.put_along_axis(rank, np.argsort(-(asks @ self.points.T), axis=1), np.broadcast_to(np.arange(len(self.points)), rank.shape), axis=1)
            walked = np.take_along_axis(rank, order[near.ravel(), 0].reshape(near.shape).astype(np.int64), axis=1)
            distance = [self.sample.footrule(order[i]) for i in range(len(asks))]
            share = [(d <= d[j]).mean() for d, own in zip(distance, near) for j in own]
            self.probes = int(np.quantile(walked, target, method="higher")) + 1
            self.keep = float(np.quantile(share, target, method="higher"))

    def lists(self, u: np.ndarray) -> np.ndarray:
        """Which lists each unit vector walks, as a query."""
        sims = u @ self.points.T
        return sims >= np.partition(sims, sims.shape[1] - self.probes, axis=1)[:, [sims.shape[1] - self.probes]]

    def limit(self, order: np.ndarray) -> int:
        """The footrule limit of a query: the ``keep`` quantile of its distances to the sample."""
        d = self.sample.footrule(order)
        at = max(1, int(np.ceil(self.keep * len(d)))) - 1
        return int(np.partition(d, at)[at])


def _described(rows: DataFrame, index: dict[int, Index]) -> DataFrame:
    """id, key (hash of the vector), dim, list (nearest pivot), v (bytes of doubles), ord (bytes of the permutation)."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            dim, home, v, order = np.zeros(n, np.int32), np.zeros(n, np.int32), [b""] * n, [b""] * n
            for d, at, x in by_length(batch.column(2)) if n else []:
                dim[at] = d
                if d in index:
                    o = orders(unit(x), index[d].points, index[d].nearest)
                    home[at] = o[:, 0]
                for i, j in enumerate(at.tolist()):
                    v[j] = x[i].tobytes()
                    order[j] = o[i].tobytes() if d in index else b""
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dim), pa.array(home), pa.array(v, pa.binary()), pa.array(order, pa.binary())], ["id", "key", "dim", "list", "v", "ord"])

    return rows.select("id", F.xxhash64("v").alias("key"), "v").mapInArrow(run, "id long, key long, dim int, list int, v binary, ord binary")


def _shards(counts: list[tuple[int, int, int]], index: dict[int, Index]) -> dict[tuple[int, int], tuple[int, int]]:
    """(dim, list) to (first shard, number of shards): short lists share a shard with their neighbours, long ones have several."""
    held, out, shard = {(d, k): n for d, k, n in counts}, {}, 0
    for d in sorted({d for d, _ in held}):
        room = SHARD
        for k in side_by_side(index[d].points) if d in index else [0]:
            n = held.get((d, k), 0)
            if n > room:
                shard, room = shard + (room < SHARD), SHARD
            out[d, k] = (shard, max(1, -(-n // SHARD)))
            if n > SHARD:
                shard += out[d, k][1]
            else:
                room -= n
        shard += 1
    return out


def _stack(col, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), -1)


def _search(rows: DataFrame, asked: DataFrame, index: dict[int, Index], places: dict[tuple[int, int], tuple[int, int]], k: int, whole: bool) -> DataFrame:
    """query_id, key, vec_id, score: the k nearest of each query in each shard it is sent to; with ``whole``, of all rows."""
    spark = rows.sparkSession
    where = spark.createDataFrame([(d, n, *place) for (d, n), place in places.items()] or [], "dim int, list int, first int, many int")  # a row per pivot

    def routed(batches):
        for batch in batches:
            shards, limits = [[] for _ in range(batch.num_rows)], np.zeros(batch.num_rows, np.int32)
            dims, vs, os = batch.column(2).to_numpy(), batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for d in np.unique(dims).tolist():
                at, own = np.flatnonzero(dims == d), sorted(n for dim, n in places if dim == d)
                walk = index[d].lists(unit(np.stack([np.frombuffer(vs[i]) for i in at.tolist()]))) if d in index and not whole else None
                for i, j in enumerate(at.tolist()):
                    lists = own if walk is None else np.flatnonzero(walk[i]).tolist()
                    shards[j] = sorted({s for n in lists for s in range(places[d, n][0], sum(places[d, n]))})
                    limits[j] = np.iinfo(np.int32).max if walk is None else index[d].limit(np.frombuffer(os[j], np.int16))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), batch.column(5), pa.array(limits), pa.array(shards, pa.list_(pa.int32()))], ["id", "key", "v", "ord", "limit", "shards"])

    sent = asked.mapInArrow(routed, "id long, key long, v binary, ord binary, limit int, shards array<int>").withColumn("shard", F.explode("shards")).drop("shards")
    blocks = sent.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    right = sent.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    left = rows.join(F.broadcast(where), ["dim", "list"]).withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("many"))).cast("int"))
    left = left.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if mine.num_rows and theirs.num_rows:
            ids, home, d = mine.column("id").to_numpy(), mine.column("list").to_numpy(), mine.column("dim")[0].as_py()
            ux, uq = unit(_stack(mine.column("v"), np.float64)), unit(_stack(theirs.column("v"), np.float64))
            asks, keys, limits = (theirs.column(c).to_numpy() for c in ("id", "key", "limit"))
            ranked = d in index and not whole
            if ranked:
                files = Inverted(_stack(mine.column("ord"), np.int16), len(index[d].points))
                q_orders, walk = _stack(theirs.column("ord"), np.int16), index[d].lists(uq)
            for i, ask in enumerate(asks.tolist()):
                fine = ids != ask
                if ranked:
                    fine &= walk[i][home] & (files.footrule(q_orders[i]) <= limits[i])
                rows_ = np.flatnonzero(fine)
                score = (ux[rows_] * uq[i]).sum(axis=1)
                if len(rows_) > k:
                    near = score >= np.partition(score, len(score) - k)[len(score) - k]
                    rows_, score = rows_[near], score[near]
                best = np.lexsort((ids[rows_], -score))[:k]
                out.append((np.full(len(best), ask), np.full(len(best), keys[i]), ids[rows_[best]], score[best]))
        a, b, c, s = (np.concatenate(p) for p in zip(*out)) if out else ([], [], [], [])
        return pa.table({"query_id": pa.array(a, pa.int64()), "key": pa.array(b, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.float64())})

    keep = ["shard", "block", "id", "v", "ord"]
    return left.select(*keep, "dim", "list").groupBy("shard", "block").cogroup(right.select(*keep, "key", "limit").groupBy("shard", "block")).applyInArrow(search, "query_id long, key long, vec_id long, score double")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` for each row of ``queries``."""
    pick = lambda df: usable(df, id_col, vec_col).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    base = pick(vectors)
    n = base.count()
    index = {d: Index(x, n, k, target) for d, x in sample_of(base, vec_col="v").items()}
    rows = cut(_described(base.dropDuplicates(["id", "v"]), index))
    asked = cut(_described(pick(queries).dropDuplicates(["id", "v"]), index))
    counts = rows.groupBy("dim", "list").agg(F.count("*").alias("n")).collect()  # at most a row per pivot and length
    places = _shards([(r["dim"], r["list"], r["n"]) for r in counts], index)
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = cut(top(_search(rows, asked, index, places, k, False)))
    full = found.groupBy("query_id", "key").agg(F.count("*").alias("n")).filter(F.col("n") == k)
    short = cut(asked.join(full.select(F.col("query_id").alias("id"), "key"), ["id", "key"], "left_anti").select(*asked.columns))
    if not short.isEmpty():
        again = top(_search(rows, short, index, places, k, True))
        found = found.join(short.select(F.col("id").alias("query_id"), "key"), ["query_id", "key"], "left_anti").select(*again.columns).unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")
