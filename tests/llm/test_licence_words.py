"""Words that no template has count with their own document frequency."""

from pathloom.llm import license_scan


def test_a_notice_with_extra_words_is_found_in_a_large_table(spark):
    line = "Released under the MIT License. project"
    rows = [(i, f"d{i}/x.py", line) for i in range(1500)]
    got = license_scan.scan(spark.createDataFrame(rows, "file_id long, path string, text string"))
    assert got.where("license = 'MIT'").count() == 1500
