"""Files of one table whose columns differ, also in type: what reads them all, and what can't be.

Spark merges the columns of files, but a column that is int in one file and bigint in another stops
it. Such files are put into groups that do merge; a file is then read with the widest type of all
groups. Only where two types have none in common do the fewer files stay out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

#: Each holds all values of those before it.
INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
FLOATS = [T.FloatType(), T.DoubleType()]


@dataclass(frozen=True)
class Group:
    """Files that merge to one schema."""

    schema: T.StructType
    files: tuple[str, ...]


@dataclass(frozen=True)
class Misfit:
    """Files whose `column` is `found` where the others have `wanted`, which has no wider type."""

    files: tuple[str, ...]
    column: str
    found: str
    wanted: str


#: What Spark raises when it reads footers, as Python sees it.
Unreadable = (PySparkException, Py4JJavaError)


def condition(error: PySparkException | Py4JJavaError) -> str:
    """Name of the error condition; not all of Spark's exceptions have a Python class."""
    thrown = error.java_exception if isinstance(error, Py4JJavaError) else error
    return (hasattr(thrown, "getCondition") and thrown.getCondition()) or ""


def cannot_merge(error: PySparkException | Py4JJavaError) -> bool:
    return condition(error).startswith("CANNOT_MERGE")


def groups(files: Sequence[str], merged: Callable[[Sequence[str]], T.StructType]) -> list[Group]:
    """Files by schema, one group per distinct one. `merged` is one distributed look at all footers.

    What does not merge is tried half by half. Files come in order of their names, so by day, and a
    type that changed on some day costs a few looks, not one per file.
    """
    by_schema: dict[str, Group] = {}
    waiting = [tuple(files)]
    while waiting:
        some = waiting.pop()
        try:
            found = Group(merged(some), some)
        except Unreadable as error:
            if not cannot_merge(error) or len(some) == 1:
                raise
            waiting += [some[: len(some) // 2], some[len(some) // 2 :]]
            continue
        key = found.schema.json()
        known = by_schema.get(key)
        by_schema[key] = Group(found.schema, found.files + (known.files if known else ()))
    return list(by_schema.values())


def wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, as Spark reads them from Parquet; None if none does."""
    if one == other:
        return one
    for kinds in (INTEGERS, FLOATS):
        if one in kinds and other in kinds:
            return max(one, other, key=kinds.index)
    if {one, other} & set(FLOATS) and {one, other} & set(INTEGERS[:3]):
        return T.DoubleType()
    return None


def common(found: Sequence[Group]) -> tuple[T.StructType, list[Misfit]]:
    """A schema with the columns of all groups but the misfits, which have as few files as can be by
    beginning with one group and adding the others, larger ones first."""
    ordered = sorted(found, key=lambda g: (-len(g.files), min(g.files)))
    tried = [_added([group, *(g for g in ordered if g is not group)]) for group in ordered]
    nothing: tuple[T.StructType, list[Misfit]] = (T.StructType([]), [])
    return min(tried, key=lambda t: sum(len(m.files) for m in t[1]), default=nothing)


def _added(ordered: Sequence[Group]) -> tuple[T.StructType, list[Misfit]]:
    fields: dict[str, T.DataType] = {}
    misfits = []
    for group in ordered:
        types = {
            f.name: wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
            for f in group.schema
        }
        wrong = next((f for f in group.schema if types[f.name] is None), None)
        if wrong is None:
            fields |= types
        else:
            kinds = wrong.dataType.simpleString(), fields[wrong.name].simpleString()
            misfits.append(Misfit(group.files, wrong.name, *kinds))
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()]), misfits
