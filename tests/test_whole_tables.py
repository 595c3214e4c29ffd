"""Queries over whole tables."""

from pathloom.plans import datasets


def test_scenes_and_places_of_whole_tables(spark, tmp_path):
    spark.range(1, 301).withColumnRenamed("id", "p_partkey").repartition(3).write.parquet(f"{tmp_path}/part.parquet")
    scenes = {r.p_partkey: r.scene for r in datasets.balanced_scenes(spark, str(tmp_path)).collect()}
    assert scenes == {k: (k - 1) // 60 for k in range(1, 301)}
    spark.range(1, 101).selectExpr("id AS c_custkey", "id % 5 AS c_nationkey", "concat('Customer#', lpad(id, 9, '0')) AS c_name").repartition(3).write.parquet(f"{tmp_path}/customer.parquet")
    places = {r.c_custkey: r.place for r in datasets.natural_sort(spark, str(tmp_path)).collect()}
    order = [k for k in range(1, 101) if k % 3] + [k for k in range(1, 101) if not k % 3]
    assert places == {k: i + 1 for i, k in enumerate(order)}
