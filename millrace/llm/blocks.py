"""Self-join of inverted lists in bounded blocks, without emitting all pairs.

A list (rows with the same key) of n rows is dealt by hash into c = ceil(n / block)
chunks; each unordered pair of chunks is one unit of work of about 2 * block rows, so
a hot list is many tasks of bounded size and every pair of its rows still meets once.
Singleton lists go, since they hold no pair.

Where only a spanning forest is wanted, ``spanning`` leaves out pairs that other links already
connect: the work of a hot list of like rows grows with its rows, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components, merged
from ..session import cut

#: Rows of one chunk of a list.
BLOCK = 2048
#: One row in so many times the chunks of a list meets all of its chunks first.
LEADERS = 32


def units(posts: DataFrame, key: list[str], row_hash: Column, block: int = BLOCK, weight: Column | None = None, weight_most: int = 1) -> DataFrame:
    """posts, repeated into units: columns plus ``unit_`` (hash of the unit), ``i_``, ``j_`` (its chunks) and ``mine_`` (the row's chunk).

    With a weight, a list is dealt into so many chunks that each has about ``weight_most`` at most.
    """
    chunks = F.col("rows_") / block if weight is None else F.greatest(F.col("rows_") / block, F.col("weight_") / weight_most)
    more = [] if weight is None else [F.sum(weight).alias("weight_")]
    sizes = posts.groupBy(*key).agg(F.count("*").alias("rows_"), *more).filter("rows_ > 1").withColumn("chunks_", F.ceil(chunks).cast("int")).select(*key, "chunks_")
    dealt = posts.join(sizes, key).withColumn("mine_", F.pmod(row_hash, F.col("chunks_")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks_") - 1))
    out = dealt.withColumn("other_", other).withColumn("i_", F.least("mine_", "other_")).withColumn("j_", F.greatest("mine_", "other_")).drop("other_", "chunks_")
    return out.withColumn("unit_", F.xxhash64(*key, "i_", "j_"))


def by_unit(dealt: DataFrame, work: Callable[[dict[str, np.ndarray]], Iterator[pa.RecordBatch] | None], schema: str, columns: list[str], key: list[str], most_bytes: int = 1 << 62) -> DataFrame:
    """Run ``work`` over whole units: it gets the rows of several complete units, sorted, with ``group_`` numbering them; rows are gathered up to 4,096 or about ``most_bytes``, or to the end of a unit."""
    names = [*key, "i_", "j_", "mine_", *columns]
    ordered = dealt.select("unit_", *names).repartition("unit_").sortWithinPartitions("unit_", *key, "i_", "j_")

    def column(col: pa.Array) -> np.ndarray:
        if pa.types.is_list(col.type):
            return np.asarray(col.flatten()).reshape(len(col), -1)
        return col.to_numpy(zero_copy_only=False)

    def run(batches):
        held: list[dict[str, np.ndarray]] = []
        n_bytes = 0

        def emit(parts, last: bool):
            rows = {n: np.concatenate([p[n] for p in parts]) for n in names}
            ids = [rows[n] for n in (*key, "i_", "j_")]
            new = np.zeros(len(ids[0]), bool)
            for c in ids:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            stop = len(new) if last else (int(starts[-1]) if len(starts) else 0)
            keep = {n: v[stop:] for n, v in rows.items()}
            done = {n: v[:stop] for n, v in rows.items()}
            done["group_"] = np.cumsum(new)[:stop]
            return done, keep

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append({n: column(batch.column(batch.schema.get_field_index(n))) for n in names})
            n_bytes += batch.nbytes
            if sum(len(h["i_"]) for h in held) < 4096 and n_bytes < most_bytes:
                continue
            done, keep = emit(held, False)
            held, n_bytes = ([keep] if len(keep["i_"]) else []), 0
            if len(done["i_"]):
                yield from work(done) or ()
        if held:
            done, _ = emit(held, True)
            yield from work(done) or ()

    return ordered.mapInArrow(run, schema)


def spanning(posts: DataFrame, key: list[str], node: str, work: Callable, kind: str, columns: list[str], block: int = BLOCK, weight: Column | None = None, weight_most: int = 1, most_bytes: int = 1 << 62) -> DataFrame:
    """a, b: links that connect the same rows as all links of all lists; ``work`` tells a forest of each unit's links.

    First each chunk meets itself and the list's leaders, a few rows drawn by hash. Of a list of
    several chunks, the rows of the component that holds most of them are then done with each
    other; they meet the other rows, and those meet each other, in blocks. ``posts`` is read
    several times, so its lineage should be cut.
    """
    weigh = F.lit(0) if weight is None else weight
    chunks = lambda n, w: F.ceil(F.greatest(n / block, w / weight_most) if weight is not None else n / block).cast("int")
    sizes = posts.groupBy(*key).agg(F.count("*").alias("rows_"), F.sum(weigh).alias("weight_")).filter("rows_ > 1")
    sizes = cut(sizes.select(*key, chunks(F.col("rows_"), F.col("weight_")).alias("chunks_")))
    place = F.xxhash64(node)
    own = F.pmod(place, F.col("chunks_")).cast("int")
    leads = (F.col("chunks_") > 1) & (F.pmod(F.xxhash64(node, F.lit("leader")), LEADERS * F.col("chunks_")) == 0)
    first = posts.join(sizes, key).withColumn("mine_", F.explode(F.when(leads, F.sequence(F.lit(0), F.col("chunks_") - 1)).otherwise(F.array(own))))
    first = first.drop("chunks_").withColumn("i_", F.col("mine_")).withColumn("j_", F.col("mine_")).withColumn("unit_", F.xxhash64(*key, "i_", "j_"))
    met = cut(by_unit(first, work, f"a {kind}, b {kind}", columns, key, most_bytes))
    large = sizes.filter("chunks_ > 1").select(*key)
    if large.isEmpty():
        return met
    found = connected_components(met, "a", "b").select(F.col("node").alias(node), F.col("component").alias("found_"))
    rows = cut(posts.join(large, key).join(found, node, "left").withColumn("found_", F.coalesce("found_", node)))
    parts = rows.groupBy(*key, "found_").agg(F.count("*").alias("rows_"), F.sum(weigh).alias("weight_"))
    main = F.max(F.struct("rows_", "found_", "weight_"))
    lists = parts.groupBy(*key).agg(main.alias("m_"), F.sum("rows_").alias("rows_"), F.sum("weight_").alias("weight_")).filter("rows_ > m_.rows_")
    lists = lists.select(*key, F.col("m_.found_").alias("main_"), chunks(F.col("m_.rows_"), F.col("m_.weight_")).alias("mains_"), F.greatest(F.lit(1), chunks(F.col("rows_") - F.col("m_.rows_"), F.col("weight_") - F.col("m_.weight_"))).alias("others_"))
    dealt = rows.join(lists, key).withColumn("in_", F.col("found_") == F.col("main_"))
    return met.unionAll(_beside_main(dealt, key, place, work, f"a {kind}, b {kind}", columns, most_bytes))


def _beside_main(dealt: DataFrame, key: list[str], place: Column, work: Callable, schema: str, columns: list[str], most_bytes: int = 1 << 62) -> DataFrame:
    """``work`` over the units in which rows outside a list's main component (``in_``) meet each other and the rows in it, in ``others_`` and ``mains_`` chunks."""
    dealt = dealt.withColumn("mine_", F.when(F.col("in_"), F.pmod(place, F.col("mains_"))).otherwise(F.col("mains_") + F.pmod(place, F.col("others_"))).cast("int"))
    other = F.explode(F.sequence(F.when(F.col("in_"), F.col("mains_")).otherwise(F.lit(0)), F.col("mains_") + F.col("others_") - 1))
    dealt = dealt.withColumn("other_", other).withColumn("i_", F.least("mine_", "other_")).withColumn("j_", F.greatest("mine_", "other_"))
    dealt = dealt.withColumn("unit_", F.xxhash64(*key, "i_", "j_"))
    return by_unit(dealt, work, schema, columns, key, most_bytes)


def beside_components(lists: DataFrame, found: DataFrame, rows: DataFrame, work: Callable, columns: list[str], block: int = BLOCK) -> DataFrame:
    """a, b: links that connect, with the links ``found``, what all links of the lists (list, id) do; of rows (id, ...).

    The rows of a list's main component are connected already. Rows outside it meet that component
    once, not once a list: its members are dealt by component, so hot lists with the same rows cost
    their rows once.
    """
    comps = cut(connected_components(found, "a", "b"))
    placed = lists.join(comps, lists["id"] == comps["node"], "left").select("list", "id", F.coalesce("component", "id").alias("found_"))
    main = placed.groupBy("list", "found_").agg(F.count("*").alias("n_")).groupBy("list").agg(F.max(F.struct("n_", "found_")).alias("m_"))
    placed = placed.join(main.select("list", F.col("m_.found_").alias("key")), "list")
    others = placed.filter("found_ <> key").select("key", "id").distinct()
    # A main row without links is its own component.
    members = comps.select(F.col("component").alias("key"), F.col("node").alias("id")).unionAll(placed.select("key", F.col("key").alias("id"))).distinct()
    met = cut(others.withColumn("in_", F.lit(False)).unionAll(members.join(others.select("key").distinct(), "key", "left_semi").select("key", "id", F.lit(True))).join(rows, "id"))
    chunks = lambda of: F.greatest(F.lit(1), F.ceil(F.count(F.when(of, 1)) / block)).cast("int")
    sizes = met.groupBy("key").agg(chunks(F.col("in_")).alias("mains_"), chunks(~F.col("in_")).alias("others_"))
    return _beside_main(met.join(sizes, "key"), ["key"], F.xxhash64("id"), work, "a long, b long", columns)


def groups_of(group: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run."""
    if not len(group):
        return []
    cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
    edges = [0, *cuts.tolist(), len(group)]
    return list(zip(edges, edges[1:]))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, node) of a spanning star forest of the links among n local nodes."""
    root = merged(np.arange(n), a, b)
    nodes = np.flatnonzero(root != np.arange(n))
    return list(zip(root[nodes].tolist(), nodes.tolist()))
