"""Packing against the tokenizer itself and the laws of the plan."""

import random
import zlib

import numpy as np

from millrace.llm import packing


def test_plan_uses_all_and_fits():
    rng = random.Random(2)
    for cap, n in ((64, 400), (2048, 5000), (2048, 40), (10, 1), (10, 0)):
        counts: dict[int, int] = {}
        for _ in range(n):
            size = min(cap, max(1, int(rng.expovariate(1 / (cap * 0.4)))))
            counts[size] = counts.get(size, 0) + 1
        used: dict[int, int] = {}
        total = 0
        for parts, many in packing.plan(counts, cap):
            assert sum(parts) <= cap and many > 0
            total += many
            for p in parts:
                used[p] = used.get(p, 0) + many
        assert used == counts
        tokens = sum(s * k for s, k in counts.items())
        assert total <= max(1.03 * tokens / cap + 2, 0)


def test_exact_complements_first():
    assert sorted(packing.plan({6: 2, 4: 1, 3: 1, 1: 1}, 10)) == [((6, 3, 1), 1), ((6, 4), 1)]
    assert packing.plan({5: 4, 2: 2, 1: 2}, 10)[0] == ((5, 5), 2)


def test_pieces_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = ["The quick brown fox, isn't it? 12 can't 3rd", "Größe für ÄÖÜ élan naïve ΣΟΦΟΣ İstanbul ﬁne", "a.b.c ... x,, --- hello. World, 'tis", "<|endoftext|> ok", "", None, "étude café ı ſ", "word " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["piece"]): r for r in packing.best_fit_packing(docs).collect()}
    tok, n = Tokenizer.from_file(packing.tokenizer_path()), 0
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part, r = ids[at : at + 2048], got[i, k]
            n += 1
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))
    assert n == len(got)
    places: dict[int, list] = {}
    for r in got.values():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 2048
