"""Nested quantifiers against a plain evaluation over all entities; closure in diamonds and cycles; traces."""

import itertools
import random

import pytest

from pathloom.operators import logic
from pathloom.operators.quantifiers import Combined, Domain, Is, Named, Quantified

ENTITIES = {"a1": "a", "a2": "a", "b1": "b", "b2": "b", "b3": "b", "r": "root"}
TYPES = {"a": {"a1", "a2"}, "b": {"b1", "b2", "b3"}, "root": set(ENTITIES), "none": set()}


def _plain(f, facts, bound):
    if isinstance(f, Is):
        return tuple(a.entity if isinstance(a, Named) else bound[a] for a in f.args) in facts[f.predicate]
    if isinstance(f, Combined):
        each = [_plain(p, facts, bound) for p in f.parts]
        value = all(each) if f.op in ("and", "nand") else any(each)
        return value != (f.op in ("nand", "nor"))
    names = [v for v, _ in f.variables]
    ways = [dict(zip(names, w)) for w in itertools.product(*(TYPES[t] for _, t in f.variables)) if len(set(w)) == len(w)]
    return (all if f.quantifier == "forall" else any)(_plain(f.body, facts, bound | w) for w in ways)


def _random(rng, bound, depth, fresh):
    if depth == 0 or (bound and rng.random() < 0.25):
        pick = lambda: rng.choice(bound) if bound and rng.random() < 0.9 else Named(rng.choice(sorted(ENTITIES)))
        return Is("p", (pick(),)) if rng.random() < 0.4 else Is("q", (pick(), pick()))
    if rng.random() < 0.5:
        return Combined(rng.choice(["and", "or", "nand", "nor"]), tuple(_random(rng, bound, depth - 1, fresh) for _ in range(rng.randint(1, 3))))
    own = tuple((f"v{next(fresh)}", rng.choice(["a", "b", "root", "root"])) for _ in range(rng.randint(1, 2)))
    return Quantified(rng.choice(["forall", "exists"]), own, _random(rng, [*bound, *(v for v, _ in own)], depth - 1, fresh))


@pytest.fixture(scope="module")
def domain(spark):
    rng = random.Random(5)
    facts = {"p": {(e,) for e in ENTITIES if rng.random() < 0.5}, "q": {(a, b) for a in ENTITIES for b in ENTITIES if rng.random() < 0.4}}
    tables = {"p": spark.createDataFrame(sorted(facts["p"]), "x string"), "q": spark.createDataFrame(sorted(facts["q"]), "x string, y string")}
    entities = spark.createDataFrame(list(ENTITIES.items()), "name string, type string")
    return Domain(entities, spark.createDataFrame([("a", "root"), ("b", "root")], "sub string, super string"), tables), facts


@pytest.mark.parametrize("seed", range(12))
def test_random_formulas(domain, seed):
    d, facts = domain
    rng, fresh = random.Random(seed), itertools.count()
    f = _random(rng, ["x", "y"], 3, fresh)
    got = {tuple(r) for r in d.satisfying(f, {"x": "a", "y": "root"}).collect()}
    assert got == {(x, y) for x in TYPES["a"] for y in TYPES["root"] if _plain(f, facts, {"x": x, "y": y})}
    closed = Quantified(rng.choice(["forall", "exists"]), (("x", "root"), ("y", "b")), f)
    assert d.holds(closed).first()[0] == _plain(closed, facts, {})


def test_bindings_and_empty_types(domain):
    d, facts = domain
    some = Quantified("exists", (("x", "b"), ("y", "b")), Combined("and", (Is("q", ("x", "y")), Quantified("exists", (("z", "root"),), Is("q", ("y", "z"))))))
    want = {(x, y) for x in TYPES["b"] for y in TYPES["b"] if x != y and (x, y) in facts["q"] and any((y, z) in facts["q"] for z in ENTITIES)}
    assert {tuple(r) for r in d.bindings(some).collect()} == want
    assert d.holds(Quantified("forall", (("x", "none"),), Is("p", ("x",)))).first()[0]
    assert not d.holds(Quantified("exists", (("x", "none"),), Is("p", ("x",)))).first()[0]
    assert d.holds(Combined("and", ())).first()[0] and not d.holds(Combined("or", ())).first()[0]


def test_refused(domain):
    d, _ = domain
    with pytest.raises(ValueError, match="named twice"):
        d.holds(Quantified("exists", (("x", "a"),), Quantified("forall", (("x", "b"),), Is("p", ("x",)))))
    with pytest.raises(ValueError, match="no type"):
        d.holds(Is("p", ("x",)))
    with pytest.raises(ValueError, match="arguments"):
        d.holds(Quantified("exists", (("x", "a"),), Is("q", ("x",))))
    small = Domain.__new__(Domain)
    small.__dict__.update(d.__dict__ | {"most": 3})
    with pytest.raises(ValueError, match="no fact binds"):
        small.satisfying(Combined("nor", (Is("q", ("x", "y")),)), {"x": "root", "y": "root"})


def test_closure_of_diamonds_and_cycles(spark):
    """Forty diamonds in a row have 2**40 paths; pairs are some thousands."""
    edges = [(f"{i}{s}", f"{i + 1}{t}") for i in range(40) for s in "xy" for t in "xy"] + [("c", "d"), ("d", "c"), (None, "0x"), ("lone", None)]
    got = {tuple(r) for r in logic.type_closure(spark.createDataFrame(edges, "sub string, super string")).collect()}
    assert ("0x", "40y") in got and ("c", "d") in got and ("d", "c") in got and ("c", "c") in got and ("lone", "lone") in got
    assert len(got) == sum(4 * (40 - i) for i in range(41)) + 82 + 4 + 1


def test_trace_of_all_nodes(spark):
    rows = list(itertools.product([False, True], repeat=3))
    tree = ("nor", ("and", "a", ("or", "b", "c")), ("nand", "b", "c"))

    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean").withColumn("t", logic.nested_trace(tree))
    for r in df.collect():
        either = r.b or r.c
        both, nand = r.a and either, not (r.b and r.c)
        want = [not (both or nand), both, r.a, either if r.a else None, r.b if r.a else None, r.c if r.a and not r.b else None]
        want += [nand if not both else None, r.b if not both else None, r.c if not both and r.b else None]
        assert [x.value for x in r.t] == want and [x.node for x in r.t] == list(range(9))
