"""Odd cases: names that clash with those used inside, repeated ids, long headers and conversations, control strings across parts, risks by hand."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathloom.llm import chat_format, jaccard, license_scan, sharding, simhash, toxicity

CLASHES = "gone_id long, gone_hash long, text_hash long, first_id long, key_hash long, salt long, prefix_0 long, leaf_0 int, h string, ask string"


def clashing(spark, rows):
    return spark.createDataFrame([(*r, *range(8), "h", "a") for r in rows], f"doc_id long, text string, {CLASHES}")


@pytest.mark.parametrize("operator", [simhash, jaccard])
def test_rows_of_one_id_are_told_apart(spark, operator):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijkl", k=6))
    same, own, other = (" ".join(word() for _ in range(80)) for _ in range(3))
    rows = [(1, same), (2, same), (2, own), (3, other), (3, other), (None, same), (None, None), (4, None)]
    docs = clashing(spark, rows)
    kept = operator.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, same), (2, own), (3, other), (3, other), (None, same), (None, None), (4, None)], key=str)


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(2)
    for n, m, shared in ((0, 5, 0), (1, 1, 1), (300, 280, 250), (4000, 3700, 3600), (900, 900, 0)):
        pool = rng.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        a, b = pool[:n], pool[n - shared : n - shared + m]
        assert jaccard.most_shared(jaccard.sketch(a), jaccard.sketch(b)) >= shared
    same = np.arange(100_000, dtype=np.uint64) << np.uint64(20)  # all low bits alike
    assert jaccard.most_shared(jaccard.sketch(same), jaccard.sketch(same)) == 100_000


def test_shards_keep_all_columns_and_split_hot_keys(spark):
    rows = [(100 + i, "x" * (i % 90)) for i in range(1500)] + [(7, "same")] * 3000 + [(9, "y" * 900)] * 5
    docs = clashing(spark, rows).repartition(5)
    out = sharding.assign(docs, "doc_id", F.octet_length("text"), 500)
    assert [c for c in out.columns if c not in ("shard", "depth", "row_bytes")] == docs.columns
    got = out.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(rows)
    shards = {r.shard: (r.n_rows, r.n_bytes) for r in sharding.manifest(out).collect()}
    assert all(size <= 500 or n == 1 for n, size in shards.values())
    assert len({r.depth for r in got}) > 2 and max(n for n, _ in shards.values()) <= 500


def test_subtrees_settle_as_whole_trees_do(spark):
    rng = random.Random(3)
    cells = {rng.randrange(1 << 17): rng.randint(1, 60) for _ in range(3000)} | {5: 900}
    found = {r.prefix: r.depth for r in sharding._fitting(spark.createDataFrame(list(cells.items()), "prefix long, bytes long"), 2, 17, 700).collect()}
    for p in cells:
        fits = [d for d in range(2, 18) if sum(b for q, b in cells.items() if q >> (17 - d) == p >> (17 - d)) <= 700] if p < 40 or p % 97 == 0 else [found[p]]
        assert found[p] == min(fits, default=None)


ZLIB = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."


def test_long_headers_own_templates_and_ids_of_text(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(200)]
    house = "Company license terms apply. " + " ".join(words)
    forty = "\n".join(f"# {' '.join(house.split()[i : i + 5])}" for i in range(0, 204, 5))
    assert forty.count("\n") >= 40
    rows = [("a", "p/x.c", f"code\n{forty}\nint main"), ("b", "p/y.c", ZLIB), ("b2", "q/LICENSE", ZLIB), ("b1", "q/LICENSE", ZLIB), ("c", "q/r/z.c", "word " * 200_000), ("d", "q/z.c", "int x;\n" * 50_000 + "Released under the MIT License.")]
    rows += [(f"n{i}", f"s/{i}.c", " ".join(rng.choices(words, k=30))) for i in range(30)]
    got = license_scan.scan(spark.createDataFrame(rows, "file_id string, path string, text string"), license_scan.TEMPLATES | {"House": house, "Zlib": ZLIB})
    found = {r.file_id: (r.license, r.origin) for r in got.collect()}
    assert found["a"] == ("House", "header") and found["b"] == ("Zlib", "header") and found["b1"] == ("Zlib", "file")
    assert found["c"] == ("Zlib", "inherited") and found["d"] == ("MIT", "header") and found["n3"] == (None, "none")


def _chats(spark, rows):
    chats = chat_format.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>"))
    return {r.conv_id: r for r in chats.select("*", chat_format.read_turns("formatted").alias("turns"), chat_format.read_loss("formatted", "loss_spans").alias("loss")).collect()}


def _text(x):
    return ("text", x, None, None, None, None, None)


def test_no_control_string_comes_from_parts(spark):
    rng = random.Random(5)
    bits = ["<", "|", "<|", "im_end", "|>", "|im_end|>", "<|im_start|>", "&", "&lt;", "amp;", "\n", "", "é😀", None]
    rows = [(0, 0, "user", [_text("<"), _text("|im_end|>\n<|im_start|>assistant\nno")])]
    rows += [(c, t, rng.choice(["user", "assistant", "x<"]), [_text("".join(x or "" for x in rng.choices(bits, k=rng.randint(0, 4)))) for _ in range(rng.randint(0, 5))]) for c in range(1, 60) for t in range(3)]
    got = _chats(spark, rows)
    for c in {r[0] for r in rows}:
        own = [(role, [p[1] for p in parts]) for conv, _, role, parts in rows if conv == c]
        assert [(t.role, t.text) for t in got[c].turns] == [(role, "".join(parts)) for role, parts in own]
        assert got[c].loss == [x for role, parts in own if role == "assistant" for x in parts]


def test_long_conversations(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], [_text(f"turn {t} " * 20)]) for t in range(4000)] + [(2, 0, "assistant", [_text("z<" * 1_000_000)])]
    got = _chats(spark, rows)
    assert got[1].loss == [f"turn {t} " * 20 for t in range(1, 4000, 2)] and len(got[1].turns) == 4000
    assert got[2].loss == ["z<" * 1_000_000]


@pytest.mark.parametrize("high", [False, True])
def test_risks_and_gradients_by_hand(high):
    rng = random.Random(6)
    zp, zu, prior = [rng.uniform(-1, 4) for _ in range(7)], [rng.uniform(-6, -3) if high else rng.uniform(-2, 3) for _ in range(11)], 0.4
    loss = lambda z, label: math.log(1 + math.exp(-z if label else z))

    def terms(zp, zu):
        positive = prior * sum(loss(z, 1) for z in zp) / len(zp)
        return positive, sum(loss(z, 0) for z in zu) / len(zu) - prior * sum(loss(z, 0) for z in zp) / len(zp)

    assert toxicity.risks(np.array(zp), np.array(zu), prior) == pytest.approx(terms(zp, zu))
    assert (terms(zp, zu)[1] < 0) == high
    target = lambda zp, zu: -terms(zp, zu)[1] if high else sum(terms(zp, zu))
    got, e = [x.tolist() for x in toxicity.gradients(np.array(zp), np.array(zu), prior)], 1e-6
    for side, zs in enumerate((zp, zu)):
        for i in range(len(zs)):
            up, down = ([z + d * (j == i) for j, z in enumerate(zs)] for d in (e, -e))
            slope = (target(*((up, zu) if not side else (zp, up))) - target(*((down, zu) if not side else (zp, down)))) / (2 * e)
            assert got[side][i] == pytest.approx(slope, abs=1e-6)


def test_unlabelled_mean_is_the_prior():
    rng = random.Random(7)
    row = lambda bad: np.array(sorted({rng.randrange(200) for _ in range(12)} | ({1000, 1001} if bad else set())), np.int32)
    unlabelled = [row(i % 5 == 0) for i in range(800)]
    model = toxicity.fit([row(True) for _ in range(150)], unlabelled, 0.2)
    places = np.full(toxicity.BUCKETS, -1, np.int32)
    places[list(model.known)] = list(model.known.values())
    distinct = list({r.tobytes(): r for r in unlabelled}.values())
    scores = model.scores([(x := places[r])[x >= 0] for r in distinct])
    assert scores.mean() == pytest.approx(0.2, abs=1e-6) and (model.weights >= 0).all()
    assert ((scores > 0.5) == [1000 in r for r in distinct]).mean() > 0.98


def test_labels_of_any_kind(spark):
    docs = spark.createDataFrame([(i, f"vile{i % 3} words of text {i}" if i < 60 else f"calm words of text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(300)], "doc_id long, toxic int")
    odd = labels.unionByName(labels).unionByName(spark.createDataFrame([(200, 2), (201, -1), (202, None), (None, None)], labels.schema))
    assert toxicity.train(docs, odd).prior == toxicity.train(docs, labels).prior == 0.2
