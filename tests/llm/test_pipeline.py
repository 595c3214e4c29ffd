"""The pipeline's stages on a small corpus with planted cases, held against what each stage should do."""

import random

import corpus_pipeline


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=rng.randint(3, 7)))
    texts = [" ".join(word() for _ in range(120)) for _ in range(400)]
    item = " ".join(word() for _ in range(30))
    toxic = set(range(0, 400, 10))
    for i in toxic:
        texts[i] += " vileness scumlike vileness"
    texts[1] = texts[2] = texts[3]
    texts[11] += " " + item
    texts[12] += ' token = "0123456789abcdef0123456789abcdef"'
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids, now = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        assert now.columns == docs.columns
        ids.append({r.doc_id for r in now.select("doc_id").collect()})
    assert ids[0] == set(range(400)) - toxic
    assert ids[1] == ids[0] - {2, 3}
    assert ids[2] == ids[1] - {11}
    assert ids[3] == ids[2]
    assert "0123456789abcdef" not in now.where("doc_id = 12").first().text
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids[3]
