"""Sharding: a permutation, gapless slots, computable either way."""

import zlib

import numpy as np

from millrace.llm import sharding


def test_permutation_and_inverse():
    for n in (1, 2, 3, 16, 17, 1000, 4097):
        at = sharding.permute(np.arange(n), n)
        assert sorted(at.tolist()) == list(range(n))
        assert sharding.permute(at, n, inverse=True).tolist() == list(range(n))
        shard, slot = sharding.place(n - 1, n)
        assert sharding.row_at(shard, slot, n) == n - 1


def test_shards(spark):
    rows = [(i if i % 50 else None, None if i % 77 == 0 else f"text {i % 90} é") for i in range(1003)]
    got = sharding.feistel_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and sorted(r["row_number"] for r in got) == list(range(len(rows)))
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
        assert (r["shard"], r["slot"]) == sharding.place(r["row_number"], len(rows))
    assert sorted(by) == list(range(16)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
