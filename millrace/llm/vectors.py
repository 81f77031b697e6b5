"""Embedding near-duplicates through a pivot-permutation index (operator 3).

Each distinct vector is described by its NEAREST reference points in order and posted
in those pivots' inverted lists, one set of lists per label and vector length. Lists are
joined in bounded blocks (blocks.py). In a block the other pivots' files count the shared
pivots of each pair; pairs with fewer than MIN_SHARED are discarded uncomputed, a pair is
taken up in the list of its smallest shared pivot only, and what is left is verified by
cosine in double precision. A block emits each vector's number of links (weighted by how
many equal vectors each stands for) and a spanning forest, never pairs, so a dense group
costs rows in proportion to its size.

The pivots come from a bounded sample (ann.SAMPLE rows) and no two are near each other, so
a dense group does not draw many. Their number grows with the square root of the rows
of the largest label (ann.pivot_count), so lists grow more slowly than the table; every vector is indexed. A
length that the sample does not hold has no pivots: its vectors (rare ones) form one list
per label, whose pairs are all verified, in blocks.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows
without label or id, link with nothing and are their own class; vectors of different length do
not link; equal vectors of a label link with each other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut
from .ann import by_length, orders, pivot_count, sample_of, thinned, unit, usable
from .blocks import by_unit, forest, groups_of, units

NEAREST = 12
MIN_SHARED = 3
COSINE = 0.93
#: Files of a block of more rows are walked one by one; those of a smaller block are counted by one product of 0/1 matrices.
WALKED = 512
#: A tile with this share of pairs left to verify is verified as a matrix product, others pair by pair.
DENSE = 0.02
NO_PIVOT = -1


def shared_pivots(order: np.ndarray, pivot: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that share ``pivot``: how many pivots each pair (left, right) shares, and which pairs share a smaller one.

    Every other pivot's file, the rows of the block that hold it, adds one to its pairs.
    """
    if len(order) <= WALKED:
        local = np.unique(order)
        has = np.zeros((len(order), len(local)), np.float32)
        np.put_along_axis(has, np.searchsorted(local, order), 1, axis=1)
        low = int(np.searchsorted(local, pivot))
        sooner = has[left, :low] @ has[right, :low].T
        return sooner + has[left, low:] @ has[right, low:].T, sooner > 0
    count, sooner = np.ones((len(left), len(right)), np.uint8), None
    place = np.full(int(max(left.max(), right.max())) + 1, -1)
    l_place, r_place = place.copy(), place
    l_place[left], r_place[right] = np.arange(len(left)), np.arange(len(right))
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    found, starts = np.unique(flat[by], return_index=True)
    for p, a, b in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(flat)]):
        if p >= pivot and sooner is None:
            sooner = count > 1
        if p == pivot:
            continue
        file = by[a:b] // order.shape[1]
        i, j = l_place[file[file < len(l_place)]], r_place[file[file < len(r_place)]]
        i, j = i[i >= 0], j[j >= 0]
        if 2 * len(j) > len(right):  # a file of most rows: whole rows are quicker
            has = np.zeros(len(right), np.uint8)
            has[j] = 1
            count[i] += has
        elif len(i) and len(j):
            count[np.ix_(i, j)] += 1
    return count, (count > 1 if sooner is None else sooner)


def _verified(v: np.ndarray, u: np.ndarray, a: np.ndarray, b: np.ndarray, s: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with cosine ``s`` of at least ``cosine``; those near the limit computed again plainly."""
    keep = s >= cosine - 1e-9
    a, b, s = a[keep], b[keep], s[keep]
    edge = np.abs(s - cosine) < 1e-9
    if edge.any():
        x, y = v[a[edge]], v[b[edge]]
        exact = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
        keep = np.ones(len(a), bool)
        keep[np.flatnonzero(edge)[exact < cosine]] = False
        a, b = a[keep], b[keep]
    return a, b


def _linked(v: np.ndarray, u: np.ndarray, maybe: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs among those marked in ``maybe`` (left, right)."""
    p, q = np.nonzero(maybe)
    if not len(p):
        return p, q
    if len(p) > DENSE * maybe.size:
        return _verified(v, u, left[p], right[q], (u[left] @ u[right].T)[p, q], cosine)
    s = np.concatenate([(u[left[p[k : k + 65_536]]] * u[right[q[k : k + 65_536]]]).sum(axis=1) for k in range(0, len(p), 65_536)])
    return _verified(v, u, left[p], right[q], s, cosine)


def links(distinct: DataFrame, n: int, cosine: float = COSINE, nearest: int = NEAREST, min_shared: int = MIN_SHARED) -> DataFrame:
    """``id, other, n`` for distinct vectors (label, id, v, mult), n of a label at most: link counts where other is null, forest edges where n is 0."""
    points = {d: x[thinned(x, pivot_count(n))] for d, x in sample_of(distinct, vec_col="v").items()}

    def describe(batches):
        for batch in batches:
            rows = batch.num_rows
            dim, v, order, lists = np.zeros(rows, np.int32), [b""] * rows, [b""] * rows, [[NO_PIVOT]] * rows
            for d, at, x in by_length(batch.column(2)) if rows else []:
                dim[at] = d
                found = orders(unit(x), points[d], nearest) if d in points else None
                for i, j in enumerate(at.tolist()):
                    v[j] = x[i].tobytes()
                    if found is not None:
                        order[j], lists[j] = found[i].tobytes(), found[i].tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dim), batch.column(1), pa.array(v, pa.binary()), batch.column(3), pa.array(order, pa.binary()), pa.array(lists, pa.list_(pa.int32()))], ["label", "dim", "id", "v", "mult", "ord", "lists"])

    label = distinct.schema["label"].dataType.simpleString()
    described = distinct.select("label", "id", "v", "mult").mapInArrow(describe, f"label {label}, dim int, id long, v binary, mult long, ord binary, lists array<int>")
    posts = described.withColumn("pivot", F.explode("lists")).drop("lists")

    def work(rows):
        ids, counts, edge_a, edge_b = [], [], [], []
        for lo, hi in groups_of(rows["group_"]):
            pivot, mine, i, j = int(rows["pivot"][lo]), rows["mine_"][lo:hi], rows["i_"][lo], rows["j_"][lo]
            v = np.frombuffer(b"".join(rows["v"][lo:hi]), np.float64).reshape(hi - lo, -1)
            own, mult, weight = rows["id"][lo:hi], rows["mult"][lo:hi], np.zeros(hi - lo, np.int64)
            u, every, all_a, all_b = unit(v), np.arange(hi - lo), [], []
            left, right = (every, every) if i == j else (np.flatnonzero(mine == i), np.flatnonzero(mine == j))
            if not len(left) or not len(right):
                continue
            if pivot == NO_PIVOT:
                maybe = np.ones((len(left), len(right)), bool)
            else:
                order = np.frombuffer(b"".join(rows["ord"][lo:hi]), np.int16).reshape(hi - lo, -1)
                count, sooner = shared_pivots(order, pivot, left, right)
                maybe = (count >= min(min_shared, order.shape[1])) & ~sooner
            if i == j:
                maybe = np.triu(maybe, 1)
            for at in range(0, len(left), 256):
                a, b = _linked(v, u, maybe[at : at + 256], left[at : at + 256], right, cosine)
                all_a.append(a)
                all_b.append(b)
            a, b = np.concatenate(all_a), np.concatenate(all_b)
            if not len(a):
                continue
            np.add.at(weight, a, mult[b])
            np.add.at(weight, b, mult[a])
            some = np.flatnonzero(weight)
            ids += own[some].tolist()
            counts += weight[some].tolist()
            for r, k in forest(hi - lo, a, b):
                edge_a.append(int(own[r]))
                edge_b.append(int(own[k]))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids + edge_a, pa.int64()), pa.array([None] * len(ids) + edge_b, pa.int64()), pa.array(counts + [0] * len(edge_a), pa.int64())], ["id", "other", "n"])

    key = ["label", "dim", "pivot"]
    return by_unit(units(posts, key, F.xxhash64("id")), work, "id long, other long, n long", ["id", "v", "mult", "ord"], key)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, **index) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, label, embedding)."""
    fine = cut(usable(vectors.select("vec_id", "label", "embedding")).filter("label is not null").select("label", F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")))
    distinct = cut(fine.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("mult")))
    most = distinct.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    found = cut(links(distinct, most or 0, cosine, **index))
    comps = connected_components(found.filter("other is not null"), "id", "other")
    degree = found.filter("other is null").groupBy("id").agg(F.sum("n").alias("n"))
    classes = distinct.join(degree, "id", "left").join(comps, F.col("id") == F.col("node"), "left").select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    linked = fine.join(classes, ["label", "v"]).groupBy("id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(linked, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
