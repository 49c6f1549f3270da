"""Bring two frames to the same columns and types before any value is compared."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallymark.functions.sqltext import quoted
from tallymark.functions.types import canonical, common_type, exact_cast


@dataclass
class Aligned:
    """Both sides with the same columns, in source order, and what could not be aligned."""

    source: DataFrame
    target: DataFrame
    columns: list[str]
    missing_in_target: list[str] = field(default_factory=list)
    missing_in_source: list[str] = field(default_factory=list)
    incompatible: list[str] = field(default_factory=list)

    @property
    def remarks(self) -> list[str]:
        return (
            [f"Column {c} not in Target" for c in self.missing_in_target]
            + [f"Column {c} not in Source" for c in self.missing_in_source]
            + [f"Column {c} of another type" for c in self.incompatible]
        )

    @property
    def unaligned(self) -> list[str]:
        """The columns that are not compared."""
        return self.missing_in_target + self.missing_in_source + self.incompatible

    @property
    def same_shape(self) -> bool:
        return not self.remarks

    @property
    def codes(self) -> list[str]:
        """Names by place, ``c0``, ``c1``, …: beside them no helper column clashes with one of the user's."""
        return [f"c{i}" for i in range(len(self.columns))]

    def code(self, columns: list[str]) -> list[str]:
        return [f"c{self.columns.index(c)}" for c in columns]

    def coded(self) -> tuple[DataFrame, DataFrame]:
        """Both sides under names by place."""
        return tuple(df.select(*[quoted(c) for c in self.columns]).toDF(*self.codes) for df in (self.source, self.target))


def free_names(names: list[str], taken: list[str]) -> list[str]:
    """The names of a report's own columns beside the user's: each with as many underscores at its end as it needs."""
    out: list[str] = []
    for name in names:
        while name in taken or name in out:
            name += "_"
        out.append(name)
    return out


def align(source: DataFrame, target: DataFrame) -> Aligned:
    """Shared columns of both sides under a common type; the rest is listed, never dropped silently."""
    source, target = canonical(source), canonical(target)
    left = {f.name: f.dataType for f in source.schema.fields}
    right = {f.name: f.dataType for f in target.schema.fields}
    shared: dict[str, T.DataType] = {}
    incompatible = []
    for name in left:
        if name in right:
            kind = common_type(left[name], right[name])
            if kind is None:
                incompatible.append(name)
            else:
                shared[name] = kind
    return Aligned(
        source=_cast(source, left, shared),
        target=_cast(target, right, shared),
        columns=list(shared),
        missing_in_target=[c for c in left if c not in right],
        missing_in_source=[c for c in right if c not in left],
        incompatible=incompatible,
    )


def _cast(df: DataFrame, types: dict[str, T.DataType], shared: dict[str, T.DataType]) -> DataFrame:
    if types == shared and df.columns == list(shared):
        return df
    return df.selectExpr(*[f"{exact_cast(quoted(c), types[c], k)} as {quoted(c)}" for c, k in shared.items()])


def with_common_types(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides whole, their shared columns cast to the common type where there is one."""
    source, target = canonical(source), canonical(target)
    left = {f.name: f.dataType for f in source.schema.fields}
    right = {f.name: f.dataType for f in target.schema.fields}
    kinds = {c: common_type(left[c], right[c]) for c in left if c in right}

    def recast(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
        wanted = {c: kinds.get(c) or kind for c, kind in types.items()}
        return _cast(df, types, wanted)

    return recast(source, left), recast(target, right)
