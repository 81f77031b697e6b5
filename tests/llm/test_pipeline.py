"""The pipeline's stages take effect and keep clean documents."""

import random

import corpus_pipeline


def test_pipeline(spark, tmp_path):
    rng = random.Random(9)
    words = "the quick brown fox jumps over a lazy dog near old river banks while birds sing".split()
    rows, labels = [], []
    for i in range(200):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(30, 120))) + "."
        junk = i % 5 == 0
        rows.append((i, " ".join(w + "$$$" for w in text.split()) if junk else text, "en", f"s{i % 3}", len(text)))
        if i % 3:
            labels.append((i, int(not junk), 0))
    for k in range(8):
        rows.append((500 + k, rows[1][1], "en", "s0", 1))
    rows.append((600, rows[2][1] + " password=hunter2hunter2", "en", "s1", 1))
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        kept[name] = docs
    ids = lambda n: [r["doc_id"] for r in kept[n].select("doc_id").collect()]
    good = {i for i in range(200) if i % 5}
    assert not any(i % 5 == 0 for i in ids("quality") if i < 200)
    assert len(good & set(ids("quality"))) >= 0.97 * len(good)
    assert not set(ids("near_duplicates")) & set(range(500, 508)) and 1 in ids("near_duplicates")
    assert kept["secrets"].filter("text like '%hunter2%'").count() == 0
    assert all(kept[n].columns == ["doc_id", "text", "lang", "source", "n_chars"] for n in ("quality", "near_duplicates", "secrets", "mixing"))
    assert set(ids("mixing")) <= set(ids("secrets")) and kept["mixing"].count() > 0
    assert sorted(set(ids("packing"))) == sorted(set(ids("mixing")))
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).select("doc_id", "length").collect())) == sorted(map(tuple, docs.select("doc_id", "length").collect()))
