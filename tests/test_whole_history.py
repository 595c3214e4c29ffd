"""Queries over whole episodes, however long."""

import datetime

from pathloom.plans import files, rollouts


def _events(spark, path, n):
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, 1, start + datetime.timedelta(seconds=i), "view", 1.0, '{"k": %d}' % (0 if i % 60 else 5)) for i in range(n)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, event_type string, value double, props string").coalesce(1).write.parquet(f"{path}/events.parquet")


def test_bats_scores_has_every_frame_of_a_long_episode(spark, tmp_path):
    _events(spark, tmp_path, 620)
    assert {r.frame_index for r in rollouts.bats_scores(spark, str(tmp_path)).collect()} == set(range(1, 620))


def test_dedup_history_looks_back_through_all(spark, tmp_path):
    _events(spark, tmp_path, 50)
    # one frame differs from all others and is 49 frames back from the last anchor
    kept = {r.kept_frame for r in rollouts.dedup_history(spark, str(tmp_path)).where("frame_index = 49").collect()}
    hashes = {r.frame_index: r.front_dhash for r in rollouts.frames(spark, str(tmp_path)).collect()}
    apart = bin(int(hashes[0], 16) ^ int(hashes[1], 16)).count("1")
    assert apart > 32 and kept == {0, 48}


def test_bats_selections_broadcast_rates_only(spark, tmp_path):
    _events(spark, tmp_path, 40)
    for made in (rollouts.bats_selection, rollouts.bats_selection_dedup):
        df = made(spark, str(tmp_path))
        # Spark's estimate of an exploded history is that of its frames, so it must not be a side of a join
        assert df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == 1
        assert df._jdf.queryExecution().executedPlan().toString().count("Join") == 1
    rows = {(r.frame_index, r.ref_frame): r for r in rollouts.bats_selection(spark, str(tmp_path)).collect()}
    assert set(rows) == {(a, b) for a in range(40) for b in range(max(a - 25, 0), a)}
    assert {b for (a, b), r in rows.items() if a == 39 and r.distance == 64} == {38}


def test_record_files_are_written_from_finished_rows(spark, tmp_path, monkeypatch):
    _events(spark, tmp_path, 30)
    plans = []
    monkeypatch.setattr(files.sinks, "write_single", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    files._record_files(spark, str(tmp_path), f"{tmp_path}/out")
    assert len(plans) == 3 and not any(x in p for p in plans for x in ("Join", "Window", "Sort"))
