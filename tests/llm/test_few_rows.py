"""Tables of few rows are not dealt to all shuffle partitions: each task costs files, whatever its rows."""

import random

import pytest

import corpus_pipeline
from pathloom.llm import components

PARTS = 48


@pytest.fixture
def many_parts(spark):
    """Many shuffle partitions that Spark does not join, and a count of the tasks since."""
    conf = {"spark.sql.shuffle.partitions": str(PARTS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    group, tracker = f"few-{random.random()}", spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, group)

    def tasks() -> int:
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        return sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))

    yield tasks
    for k, v in before.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_few_edges_take_few_tasks(spark, many_parts):
    """A chain needs several rounds; rounds do not deal its few edges to all partitions again and again."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u long, v long")
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert roots == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert 0 < many_parts() < 16 * PARTS


def test_few_near_copies_take_few_tasks(spark, many_parts):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(6)]
    texts = [" ".join(x) for x in base] + [" ".join([*x[:58], "other", "words"]) for x in base]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == set(range(6))
    assert 0 < many_parts() < 80 * PARTS
