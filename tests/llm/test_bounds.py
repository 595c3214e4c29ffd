"""Rows that reach the driver, and directories that hold very many files or directories."""

from pathloom.llm import license_scan, toxicity


def test_rows_of_one_id_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda positive, unlabelled, prior: seen.append((len(positive), len(unlabelled), prior)))
    name = lambda i: "".join(chr(97 + int(c)) for c in str(i)) * 3
    docs = spark.createDataFrame([(7, f"vile words named {name(i)}") for i in range(300)] + [(7, f"vile words named {name(1)}")] * 50 + [(i, f"other text of {name(i)}") for i in range(100, 140)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(7, 1), (100, 0), (101, 1)], "doc_id long, toxic int")
    toxicity.train(docs, labels, max_positive=20, max_unlabelled=30)
    toxicity.train(docs, labels, max_positive=4000, max_unlabelled=10000)
    assert seen[0] == (20, 30, 2 / 3) and seen[1] == (301, 340, 2 / 3)


def test_a_deep_root_and_a_flat_directory(spark):
    """A licence at the root and one in a directory of very many files; directories of many levels and of many siblings."""
    mit = license_scan.TEMPLATES["MIT"]
    rows = [("root", "/LICENSE", license_scan.TEMPLATES["GPL-3.0"]), ("flat", "/src/flat/LICENSE", mit)]
    wide = spark.createDataFrame(rows, "file_id string, path string, text string").unionByName(
        spark.range(100_000).selectExpr("concat('f', id) AS file_id", "concat('/src/flat/', id, '.txt') AS path", "'plain words' AS text")
    ).unionByName(spark.range(3000).selectExpr("concat('d', id) AS file_id", "concat('/src/dirs/', id, '/a/b/c/d/e/x.txt') AS path", "'plain words' AS text"))
    got = {tuple(r): r["count"] for r in license_scan.scan(wide).groupBy("license", "origin", "licensed_dir").count().collect()}
    assert {k[:3]: n for k, n in got.items()} == {("MIT", "inherited", "/src/flat"): 100_000, ("GPL-3.0", "inherited", ""): 3000, ("GPL-3.0", "file", ""): 1, ("MIT", "file", "/src/flat"): 1}
