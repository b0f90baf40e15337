"""Extraction: all configs of a table as one generator over the parsed document.

The configs of a table become one array of records per document, exploded once.
Compared with a union of one branch per config this scans and parses the corpus
once, and compared with filters over the parsed column it leaves nothing the
optimizer could push below the parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.operators.parse import Element, element_tree
from docmart.plans.config import DomainConfig, Field, Step

CONFIG = "config"
_PREFIX = "__"


def lookup_keys(out: str) -> tuple[str, str, str]:
    """Helper columns that carry a lookup's system, code and default."""
    return f"{_PREFIX}{out}_system", f"{_PREFIX}{out}_code", f"{_PREFIX}{out}_default"


def _filtered(elements: Column, node: Element, step: Step) -> Column:
    if not step.where:
        return elements

    def wanted(element: Column) -> Column:
        keep = F.lit(True)
        for path, text in step.where.items():
            keep = keep & node.has(element, path, text)
        return keep

    return F.filter(elements, wanted)


def _elements(root: Element, doc: Column, steps: Sequence[Step], make) -> Column:
    """Array of ``make(nodes, columns, position)`` over all elements the hops reach.

    Without ``make`` the elements themselves.
    """

    def walk(nodes: list[Element], columns: list[Column], rest: Sequence[Step]) -> Column:
        node, elements = nodes[-1].elements(columns[-1], rest[0].path)
        elements = _filtered(elements, node, rest[0])
        if len(rest) == 1 and make is None:
            return elements
        if len(rest) == 1:
            return F.transform(elements, lambda e, i: make([*nodes, node], [*columns, e], i))
        inner = F.transform(elements, lambda e: F.coalesce(walk([*nodes, node], [*columns, e], rest[1:]), F.array()))
        return F.flatten(inner)

    return walk([root], [doc], steps)


def records_array(config: DomainConfig, root: Element, doc: Column, make=None) -> Column:
    """The records of one document as an array, each built by ``make``."""
    if not config.records:
        return F.array(make([root], [doc], F.lit(0)) if make else F.lit(True))
    return _elements(root, doc, config.records, make)


def field_columns(f: Field, nodes: list[Element], columns: list[Column], index: Column) -> dict[str, Column]:
    if f.kind == "path":
        return {f.out: nodes[-1].value(columns[-1], f.path)}
    if f.kind == "document":
        return {f.out: nodes[0].value(columns[0], f.path)}
    if f.kind == "step":
        return {f.out: nodes[f.level + 1].value(columns[f.level + 1], f.path)}
    if f.kind == "constant":
        return {f.out: F.lit(f.value).cast("string")}
    if f.kind == "position":
        return {f.out: index.cast("string")}
    if f.kind == "doc_id":
        return {f.out: F.col("doc_id")}
    if f.kind == "lookup":
        system, code, default = lookup_keys(f.out)
        systems = [nodes[-1].value(columns[-1], f.system_path)] if f.system_path else []
        return {
            system: F.coalesce(*systems, F.lit(f.system).cast("string")),
            code: nodes[-1].value(columns[-1], f.path),
            default: F.lit(f.value).cast("string"),
        }
    raise ValueError(f"unknown field kind {f.kind}")


def _output_names(configs: Sequence[DomainConfig]) -> list[str]:
    names: dict[str, None] = {}
    for config in configs:
        for f in config.fields:
            for name in lookup_keys(f.out) if f.kind == "lookup" else (f.out,):
                names.setdefault(name)
    return list(names)


def lookup_columns(configs: Sequence[DomainConfig]) -> list[str]:
    """Output columns that some config fills from the codemap."""
    names: dict[str, None] = {}
    for config in configs:
        for f in config.fields:
            if f.kind == "lookup":
                names.setdefault(f.out)
    return list(names)


def extract(
    parsed: DataFrame,
    configs: Sequence[DomainConfig],
    parsed_for: Sequence[DomainConfig] | None = None,
    place: bool = False,
) -> DataFrame:
    """Records of all ``configs`` as text columns, with their document and config.

    A column that a config does not declare is null in its rows. ``parsed_for``
    are the configs the documents were parsed for, if more than ``configs``. With
    ``place`` each record also tells its file and its number in it, as
    ``__file, __place``.
    """
    root = element_tree(parsed_for or configs)
    names = _output_names(configs)
    doc = F.col("doc")
    arrays = []
    for config in configs:

        def make(nodes, columns, index, config=config):
            values: dict[str, Column] = {}
            for f in config.fields:
                values |= field_columns(f, nodes, columns, index)
            cells = [values.get(n, F.lit(None).cast("string")).alias(f"r_{i}") for i, n in enumerate(names)]
            return F.struct(F.lit(config.name).alias("r_config"), *cells)

        arrays.append(F.coalesce(records_array(config, root, doc, make), F.array()))
    every = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    every = F.when(F.col("error").isNull(), every)
    where = []
    if place:
        where = [F.col("r_file").alias("__file"), F.col("pos").alias("__place")]
        rows = parsed.select(F.col("doc_id").alias("r_doc"), F.col("file_name").alias("r_file"), F.posexplode(every))
        rows = rows.select("r_doc", "r_file", "pos", "col.*")
    else:
        rows = parsed.select(F.col("doc_id").alias("r_doc"), F.inline(every))
    own_id = [] if "doc_id" in names else [F.col("r_doc").alias("doc_id")]
    return rows.select(
        *where, *own_id, F.col("r_config").alias(CONFIG), *[F.col(f"r_{i}").alias(n) for i, n in enumerate(names)]
    )


def with_counts(parsed: DataFrame, configs: Sequence[DomainConfig]) -> DataFrame:
    """Add ``counts``: per config the number of records, null where it has no data.

    The counts are array sizes, so no record is exploded to be counted. In a
    stored stage the reports read this column and nothing of the documents.
    """
    root = element_tree(configs)
    sizes = []
    for config in configs:
        n = F.array_size(records_array(config, root, F.col("doc")))
        sizes.append(F.when(F.col("error").isNull() & (n > 0), n).cast("bigint").alias(config.name))
    return parsed.withColumn("counts", F.struct(*sizes))
