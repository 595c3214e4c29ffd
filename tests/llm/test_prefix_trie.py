"""The trie against a plain one in Python; merging with common prefixes; odd tables."""

import hashlib
import random

import pytest
from pathloom.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def _brute(rows):
    """Nodes of the trie of whole conversations."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: tuple((r, t) for _, _, r, t in sorted(own)) for c, own in convs.items()}
    nodes = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        kids = lambda q: sum(1 for x in nodes if len(x) == len(q) + 1 and x[: len(q)] == q)
        ends = sorted(c for c in members if paths[c] == p)
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in under)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids(p), sum(kids(q) == 0 for q in under), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, n, alphabet=2, most=5):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"][:alphabet]), rng.choice(["a", "é", ""][:alphabet])) for c in range(-n // 2, n // 2) for t in range(rng.randint(1, most))]


def _trie(spark, rows, **options):
    table = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA)
    return sorted(map(tuple, pt.trie(pt.sequences(table.repartition(3)), **options).collect()), key=str)


@pytest.mark.parametrize("task_bytes", [1 << 30, 200])
def test_as_a_plain_trie(spark, task_bytes):
    """In many small tasks, most nodes are open over several."""
    rows = _rows(1, 60) + [(1000 + i, t, "user", "same") for i in range(40) for t in range(3)] + [(5000, t, "user", "x") for t in range(200)]
    rows += [(None, 1, "user", "lost"), (7000, None, None, None), (7000, 1, "user", None), (7001, 0, "", ""), (7001, 0, "", "")]
    assert _trie(spark, rows, task_bytes=task_bytes) == _brute(rows)


def test_ties_of_a_turn_number_go_by_role_and_do_not_depend_on_order(spark):
    rows = [(1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "assistant", "z"), (2, 0, "assistant", "z")]
    got = _trie(spark, rows)
    assert got == _trie(spark, rows[::-1]) and len(got) == 4 and sorted(r[3] for r in got) == [1, 1, 2, 2]


@pytest.mark.parametrize("seed", range(6))
def test_random_tries(spark, seed):
    rows = _rows(seed, 80)
    assert _trie(spark, rows, task_bytes=300) == _brute(rows)


def test_copies_fill_several_tasks(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(4)] + [(900, 0, "user", "t0"), (901, 0, "user", "z")]
    assert _trie(spark, rows, task_bytes=1000) == _brute(rows)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pt.trie(pt.sequences(none)).count() == 0
    two = spark.createDataFrame([(1, []), (2, [])], "conv_id long, turns array<struct<key:binary,bytes:bigint>>")
    assert [tuple(r) for r in pt.trie(two).collect()] == [(1, 0, None, 2, 0, 1, 0, hashlib.sha256(b"1,2").hexdigest())]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8])
def test_merge_is_sorted_with_its_prefixes_and_compares_few_turns(k):
    rng = random.Random(k)
    common = tuple(b"%03d" % i for i in range(100))
    records = [((*common[: rng.choice([0, 100, 100])], *(bytes([rng.randint(0, 2)]) for _ in range(rng.randint(0, 4)))), i, []) for i in range(50 * k)]
    runs = [pt.Run(records[i::k]) for i in range(k)]
    tree = pt.LoserTree(runs)
    got = list(tree)
    assert [r for r, _ in got] == sorted(records, key=lambda r: r[:2])
    assert [n for _, n in got] == [pt.shared(got[i - 1][0][0], r[0], 0) if i else 0 for i, (r, _) in enumerate(got)]
    assert tree.compared <= 100 * (k + 5) + 12 * len(records)  # the hundred turns are not compared for each record anew


def test_pieces_of_ids(spark):
    rows = [(c, 0, "user", "x") for c in range(50)]
    old, pt.PIECE = pt.PIECE, 3
    try:
        nodes = list(pt.task_nodes([pt.Run([((b"k",), c, [1]) for c in range(50)])], 0))
    finally:
        pt.PIECE = old
    assert ",".join(r[-1] for r in nodes if r[-1]) == ",".join(map(str, range(50)))
    assert _trie(spark, rows) == _brute(rows)
