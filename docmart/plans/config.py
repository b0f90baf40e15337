"""Declarations: what a record is, which paths become columns, where they go.

A :class:`DomainConfig` is one extraction recipe. Declarations hold names and
paths only; :mod:`docmart.operators.extract` compiles them to Column expressions.
Paths are dotted element names, attributes carry a leading underscore:
``effectiveTime.low._value``. A path that ends at an element means its text. A
name followed by ``[]`` is a repeated element, of which a value path takes the
first: ``id[]._extension``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from docmart.functions.schema import table_schema


@dataclass(frozen=True)
class Step:
    """One hop towards the records: an element below the previous hop.

    ``many`` marks a repeated element; ``where`` keeps only elements whose paths
    equal the given texts, each in any of its repeated elements.
    """

    path: str
    many: bool = True
    where: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Field:
    """One output column of a config; build it with the functions below."""

    out: str
    kind: str
    path: str = ""
    system_path: str = ""
    value: str | None = None
    level: int = -1
    system: str | None = None


def from_path(out: str, path: str) -> Field:
    """Value at a path relative to the record."""
    return Field(out, "path", path)


def from_document(out: str, path: str) -> Field:
    """Value at a path relative to the document root."""
    return Field(out, "document", path)


def from_step(out: str, level: int, path: str) -> Field:
    """Value at a path relative to the element of hop ``level`` (0 = first hop)."""
    return Field(out, "step", path, level=level)


def constant(out: str, value: str) -> Field:
    return Field(out, "constant", value=value)


def position(out: str) -> Field:
    """Zero-based place of the record in its innermost repeated element."""
    return Field(out, "position")


def document_id(out: str = "doc_id") -> Field:
    return Field(out, "doc_id")


def code_lookup(
    out: str, system_path: str, code_path: str, default: int | None = 0, system: str | None = None
) -> Field:
    """Standard concept of the source code found at two record paths.

    ``system`` is the code system of records that carry none at ``system_path``,
    which may then be empty.
    """
    return Field(out, "lookup", code_path, system_path, None if default is None else str(default), system=system)


@dataclass(frozen=True)
class DomainConfig:
    """One recipe. Without ``records`` every document gives one row."""

    name: str
    fields: tuple[Field, ...]
    records: tuple[Step, ...] = ()

    def __post_init__(self) -> None:
        outs = [f.out for f in self.fields]
        if len(set(outs)) != len(outs):
            raise ValueError(f"config {self.name}: a column is declared twice")
        for f in self.fields:
            if f.kind == "step" and not 0 <= f.level < len(self.records):
                raise ValueError(f"config {self.name}: column {f.out} names hop {f.level}")


def select_configs(configs: Sequence[DomainConfig], names: Iterable[str] | str | None = None) -> list[DomainConfig]:
    """All configs for ``None`` or ``''``, else the named ones, in declaration order."""
    if not configs:
        raise ValueError("no configs")
    if not names:
        return list(configs)
    wanted = {names} if isinstance(names, str) else set(names)
    unknown = wanted - {c.name for c in configs}
    if unknown:
        raise ValueError(f"unknown configs: {sorted(unknown)}")
    return [c for c in configs if c.name in wanted]


def without_fields(configs: Iterable[DomainConfig]) -> list[DomainConfig]:
    """The configs' records only: enough to count them, with far less to parse."""
    return [DomainConfig(c.name, (), c.records) for c in configs]


@dataclass(frozen=True)
class Routing:
    """config -> domain -> table, and the declared column types of each table."""

    domain_of: Mapping[str, str]
    table_of: Mapping[str, str]
    types_of: Mapping[str, Mapping[str, Any]]

    def domain(self, config: str) -> str | None:
        return self.domain_of.get(config)

    def table(self, config: str) -> str | None:
        """Table of a config, or None where any hop is missing."""
        table = self.table_of.get(self.domain_of.get(config, ""))
        return table if table in self.types_of else None

    def schema(self, table: str) -> T.StructType:
        return table_schema(self.types_of[table])

    def tables(self, configs: Iterable[DomainConfig]) -> dict[str, list[DomainConfig]]:
        """Configs grouped by table, in declaration order; unmapped ones left out."""
        grouped: dict[str, list[DomainConfig]] = {}
        for config in configs:
            table = self.table(config.name)
            if table is not None:
                grouped.setdefault(table, []).append(config)
        return grouped

    def select_domains(self, include: Iterable[str] | None = None, exclude: Iterable[str] = ()) -> Routing:
        """Routing restricted to some domains; configs of the others become unmapped."""
        kept = set(self.table_of) if include is None else set(include)
        kept -= set(exclude)
        return Routing(self.domain_of, {d: t for d, t in self.table_of.items() if d in kept}, self.types_of)
