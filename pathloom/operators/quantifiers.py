"""Formulas with nested quantifiers over typed variables, compiled to joins.

A formula is brought to and, or, exists and their negations, which are pushed inwards: "for all x, f" is "there is no x
with not f". What satisfies a formula is a table with a column per free variable: facts are read as they are, a conjunction
joins its parts and takes away (anti-join) what its negated parts hold, a disjunction is a union, and a quantifier
drops its variables and repeated rows. So the universe is multiplied only where a variable is bound by no fact at
all, and then its sizes are counted first and refused beyond a bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.operators.logic import type_closure
from pathloom.operators.prefix import checkpointed


@dataclass(frozen=True)
class Is:
    """A predicate of variables; a ``Named`` argument is an entity itself."""

    predicate: str
    args: tuple[str | Named, ...]


@dataclass(frozen=True)
class Named:
    entity: str


@dataclass(frozen=True)
class Combined:
    """``op`` is and, or, nand or nor."""

    op: str
    parts: tuple[Formula, ...]


@dataclass(frozen=True)
class Quantified:
    """``quantifier`` is forall or exists; ``variables`` are (name, type), and stand for entities that differ from each other."""

    quantifier: str
    variables: tuple[tuple[str, str], ...]
    body: Formula


Formula = Is | Combined | Quantified


@dataclass(frozen=True)
class _Fact:
    atom: Is
    true: bool


@dataclass(frozen=True)
class _Group:
    every: bool
    parts: tuple[_Normal, ...]


@dataclass(frozen=True)
class _Some:
    """``true``: some entities for ``variables`` satisfy the body; else none do."""

    variables: tuple[tuple[str, str], ...]
    body: _Normal
    true: bool


_Normal = _Fact | _Group | _Some


def normal(f: Formula, true: bool = True) -> _Normal:
    """``f``, or what holds where it does not, with negation at facts and quantifiers only."""
    if isinstance(f, Is):
        return _Fact(f, true)
    if isinstance(f, Combined):
        if f.op not in ("and", "or", "nand", "nor"):
            raise ValueError(f"{f.op} is no operation")
        sign = true == (f.op in ("and", "or"))
        return _Group((f.op in ("and", "nand")) == sign, tuple(normal(p, sign) for p in f.parts))
    if f.quantifier not in ("forall", "exists"):
        raise ValueError(f"{f.quantifier} is no quantifier")
    exists = f.quantifier == "exists"
    return _Some(f.variables, normal(f.body, exists), true == exists)


def free(f: _Normal) -> set[str]:
    if isinstance(f, _Fact):
        return {a for a in f.atom.args if isinstance(a, str)}
    if isinstance(f, _Group):
        return set().union(*(free(p) for p in f.parts))
    return free(f.body) - {v for v, _ in f.variables}


_ROW = "__row"  # the column of a table over no variables, which has a row if the formula holds


class Domain:
    """Entities (name, type), types ``parents(sub, super)``, and for each predicate the table of what it is true of, one column per argument."""

    def __init__(self, entities: DataFrame, parents: DataFrame, facts: dict[str, DataFrame], most: int = 1_000_000):
        self.spark = entities.sparkSession
        self.typed = entities.select("name", F.col("type").alias("sub")).join(type_closure(parents), "sub", "left")
        self.typed = checkpointed(self.typed.select("name", F.coalesce("super", "sub").alias("type")).distinct())
        self.facts, self.most = facts, most

    def of_type(self, kind: str, name: str) -> DataFrame:
        return self.typed.where(F.col("type") == kind).select(F.col("name").alias(name))

    def satisfying(self, f: Formula, variables: dict[str, str] | None = None) -> DataFrame:
        """The distinct entities for the free ``variables`` (name: type) that satisfy ``f``, a column each."""
        types = dict(variables or {})
        found = self._positive(normal(f), types)
        return self._extended(found, list(types), types).select(*types).distinct()

    def bindings(self, f: Quantified) -> DataFrame:
        """The entities that satisfy the body of an "exists", a column per variable."""
        if f.quantifier != "exists":
            raise ValueError("only what exists has bindings")
        inside = self._inside(_Some(f.variables, normal(f.body), True), {})
        return inside.select(*(v for v, _ in f.variables)).distinct()

    def holds(self, f: Formula) -> DataFrame:
        """Whether a formula without free variables holds: one row."""
        return self._positive(normal(f), {}).agg((F.count("*") > 0).alias("holds"))

    # tables of what satisfies a part; ``types`` has the types of the variables around it

    def _true(self) -> DataFrame:
        return self.spark.range(1).select(F.lit(1).alias(_ROW))

    def _fact(self, atom: Is, types: dict[str, str]) -> DataFrame:
        df = self.facts[atom.predicate]
        if len(df.columns) != len(atom.args):
            raise ValueError(f"{atom.predicate} has {len(df.columns)} arguments")
        df = df.toDF(*(f"__{i}" for i in range(len(atom.args))))
        first: dict[str, int] = {}
        for i, a in enumerate(atom.args):
            if isinstance(a, Named):
                df = df.where(F.col(f"__{i}") == a.entity)
            elif a in first:
                df = df.where(F.col(f"__{i}") == F.col(f"__{first[a]}"))
            else:
                first[a] = i
        if unknown := set(first) - set(types):
            raise ValueError(f"no type is known of {', '.join(sorted(unknown))}")
        df = df.select(*(F.col(f"__{i}").alias(a) for a, i in first.items()), *([] if first else [F.lit(1).alias(_ROW)])).distinct()
        for a in first:
            df = df.join(self.of_type(types[a], a), a, "left_semi")
        return df

    def _inside(self, f: _Some, types: dict[str, str]) -> DataFrame:
        names = [v for v, _ in f.variables]
        if len(set(names)) < len(names) or set(names) & set(types):
            raise ValueError(f"{', '.join(names)}: a variable is named twice")
        inner = types | dict(f.variables)
        found = self._extended(self._positive(f.body, inner), names, inner)
        apart = [F.col(a) != F.col(b) for i, a in enumerate(names) for b in names[:i]]
        return found.where(reduce(Column.__and__, apart)) if apart else found

    def _absolute(self, f: _Fact | _Some, types: dict[str, str]) -> DataFrame:
        """What satisfies ``f`` without its sign, over its free variables."""
        if isinstance(f, _Fact):
            return self._fact(f.atom, types)
        found = self._inside(f, types)
        keep = [v for v in self._columns(found) if v not in dict(f.variables)]
        return (found.select(*keep) if keep else found.select(F.lit(1).alias(_ROW))).distinct()

    def _positive(self, f: _Normal, types: dict[str, str]) -> DataFrame:
        if isinstance(f, _Group):
            return self._every(f.parts, types) if f.every else self._any(f.parts, types)
        return self._absolute(f, types) if f.true else self._every((f,), types)

    def _every(self, parts: tuple[_Normal, ...], types: dict[str, str]) -> DataFrame:
        """Signed parts are joined first; the negated ones are then taken away from what binds their variables."""
        plain = [self._positive(p, types) for p in parts if isinstance(p, _Group) or p.true]
        found = plain.pop(0) if plain else self._true()
        while plain:  # what shares a variable with the rest comes first
            bound = set(self._columns(found))
            plain.sort(key=lambda d: not bound & set(self._columns(d)))
            found = self._joined(found, plain.pop(0))
        for p in parts:
            if not isinstance(p, _Group) and not p.true:
                gone = self._absolute(p, types)
                found = self._extended(found, self._columns(gone), types)
                found = self._without(found, gone)
        return found

    def _any(self, parts: tuple[_Normal, ...], types: dict[str, str]) -> DataFrame:
        if not parts:
            return self._true().limit(0)
        tables = [self._positive(p, types) for p in parts]
        names = sorted({c for t in tables for c in self._columns(t)})
        wide = [self._extended(t, names, types).select(*(names or [_ROW])) for t in tables]
        return reduce(DataFrame.unionByName, wide).distinct()

    @staticmethod
    def _columns(df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != _ROW]

    def _joined(self, a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in self._columns(a) if c in self._columns(b)]
        if shared:
            return a.drop(_ROW).join(b.drop(_ROW), shared)
        if not self._columns(a) or not self._columns(b):  # one of them has at most one row: it holds or not
            one, other = (a, b) if not self._columns(a) else (b, a)
            return other.where(F.lit(not one.isEmpty()))
        return self._product(a, b)

    def _product(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """All pairs, which share no variable: counted, and refused beyond the bound."""
        if (n := a.count() * b.count()) > self.most:
            raise ValueError(f"{', '.join(a.columns)} and {', '.join(b.columns)} have {n} pairs and no fact binds them; the bound is {self.most}")
        return a.crossJoin(F.broadcast(b))

    def _extended(self, df: DataFrame, names: list[str], types: dict[str, str]) -> DataFrame:
        """``df`` with a column for each of ``names``; those it lacks stand for all entities of their types."""
        for v in names:
            if v not in df.columns:
                df = self._joined(df, self.of_type(types[v], v))
        return df

    def _without(self, a: DataFrame, b: DataFrame) -> DataFrame:
        shared = self._columns(b)
        return a.join(b, shared, "left_anti") if shared else a.where(F.lit(b.isEmpty()))
