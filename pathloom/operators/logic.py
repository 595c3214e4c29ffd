"""Typed entities, quantified predicates and boolean formulas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.prefix import checkpointed


def type_closure(parents: DataFrame) -> DataFrame:
    """All (sub, super) pairs over ``parents(sub, super)``, each type under itself too. Types in a cycle are under each other.

    Each round joins the distinct pairs found so far with themselves, so it doubles the length of the paths it covers:
    as many rounds as the logarithm of the longest path, and no path is carried, however many lead from one type to another.
    """
    edges = parents.where("sub is not null and super is not null").select("sub", "super")
    types = parents.select(F.col("sub").alias("t")).unionByName(parents.select(F.col("super").alias("t"))).where("t is not null")
    pairs = checkpointed(edges.unionByName(types.select(F.col("t").alias("sub"), F.col("t").alias("super"))).distinct())
    n, before = pairs.count(), -1
    while n != before:
        on = pairs.select(F.col("sub").alias("super"), F.col("super").alias("__above"))
        pairs = checkpointed(pairs.join(on, "super").select("sub", F.col("__above").alias("super")).distinct())
        n, before = pairs.count(), n
    return pairs


def assignments(entities: DataFrame, closure: DataFrame, wanted: list[str], ordered: bool = True, most: int = 10_000) -> DataFrame:
    """Distinct entities for each wanted type, subtypes included: columns e0, e1, …

    ``ordered`` gives permutations; else combinations, each set once. The result is the
    product of what fits each type, so the universe of a domain must be small: ValueError
    if there are more than ``most`` entities.
    """
    if entities.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} entities")
    typed = entities.join(closure.withColumnRenamed("sub", "type"), "type")
    sides = [typed.where(F.col("super") == t).select(F.col("name").alias(f"e{i}")).distinct() for i, t in enumerate(wanted)]
    out = sides[0]
    for i, side in enumerate(sides[1:], 1):
        apart = [(F.col(f"e{j}") != F.col(f"e{i}")) if ordered else (F.col(f"e{j}") < F.col(f"e{i}")) for j in range(i)]
        out = out.join(side, reduce(Column.__and__, apart))
    return out


def quantified(df: DataFrame, keys: list[str], truth: Column, forall: bool) -> DataFrame:
    return df.groupBy(*keys).agg((F.bool_and(truth) if forall else F.bool_or(truth)).alias("holds"))


def formula(tree: tuple | str) -> Column:
    """A boolean expression of (op, part, …) with op in and, nand, or, nor; leaves are column names."""
    if isinstance(tree, str):
        return F.col(tree)
    op, *parts = tree
    sides = [formula(p) for p in parts]
    joined = reduce(Column.__and__ if op in ("and", "nand") else Column.__or__, sides)
    return ~joined if op in ("nand", "nor") else joined


def truth_trace(tree: tuple) -> Column:
    """What the parts of ``tree`` are found to be, in order, until one decides it; those after that are null."""
    op, *parts = tree
    stop = op in ("or", "nor")  # the value that ends the evaluation
    seen, out = F.lit(True), []
    for part in parts:
        value = formula(part)
        out.append(F.when(seen, value))
        seen = seen & (value != F.lit(stop))
    return F.array(*out)


def nested_trace(tree: tuple | str) -> Column:
    """(node, value) of all nodes of ``tree`` in pre-order, 0 at the root; the value is null where nobody asked for it.

    A part is asked for if its parent is, and no part of the parent before it has decided. Only then is it evaluated.
    """
    rows: list[Column] = []

    def visit(node: tuple | str, asked: Column) -> None:
        rows.append(F.struct(F.lit(len(rows)).alias("node"), F.when(asked, formula(node)).alias("value")))
        if isinstance(node, str):
            return
        op, *parts = node
        for part in parts:
            visit(part, asked)
            asked = asked & (formula(part) != F.lit(op in ("or", "nor")))

    visit(tree, F.lit(True))
    return F.array(*rows)
