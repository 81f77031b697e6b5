"""Token attribution against a loop over tokens."""

import random

import numpy as np

from millrace.llm import attribution, packing


def plain(ends, spans):
    counts, outside, start = [0] * len(spans), 0, 0
    for end in ends:
        over = [min(end, b) - max(start, a) for a, b in spans]
        if over and max(over) > 0:
            counts[over.index(max(over))] += 1
        else:
            outside += 1
        start = end
    return counts, outside


def test_rule():
    rng = random.Random(1)
    for _ in range(300):
        ends = np.cumsum([rng.randint(1, 6) for _ in range(rng.randint(0, 30))])
        cuts = sorted(rng.sample(range(0, 120), 2 * rng.randint(0, 8)))
        spans = list(zip(cuts[::2], cuts[1::2]))
        lo, hi = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
        n, outside, _ = attribution.attribute(np.asarray(ends, np.int64), lo, hi)
        assert (n.tolist(), outside) == plain(ends.tolist(), spans)


def test_lines_and_spans(spark):
    text = "Größe eins\n\nzwei drei 🙂\nend"
    docs = spark.createDataFrame([(1, text, [{"start": 0, "end": 5}, {"start": 6, "end": 10}]), (2, None, None), (3, "", [])], "doc_id long, text string, f array<struct<start:int,end:int>>")
    got = attribution.token_counts(docs.drop("f")).orderBy("doc_id", "section").collect()
    enc = attribution.Encoder(packing.tokenizer_path(attribution.TOKENIZER))
    mine = [r for r in got if r["doc_id"] == 1]
    assert sum(r["n_tokens"] for r in mine) == len(enc.ends(text)) == mine[0]["doc_tokens"]
    assert [text[r["start"] : r["end"]] for r in mine] == ["Größe eins\n", "\n", "zwei drei 🙂\n", "end"]
    assert [(r["n_tokens"], r["section"]) for r in got if r["doc_id"] in (2, 3)] == [(0, 0), (0, 0)]
    fields = attribution.token_counts(docs, "f").filter("doc_id = 1").orderBy("section").collect()
    assert [r["section"] for r in fields] == [-1, 0, 1]
    assert sum(r["n_tokens"] for r in fields) == mine[0]["doc_tokens"]
