"""The conversion job: documents to one typed table per domain."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docmart.operators import report
from docmart.operators.align import align
from docmart.operators.extract import extract, with_counts
from docmart.operators.lookup import apply_lookups, unique_codemap
from docmart.operators.parse import parse_documents, quarantine, read_documents
from docmart.operators.rules import Rule, rule_records, run_rule
from docmart.operators.route import routes_frame, unrouted
from docmart.plans.config import DomainConfig, Routing, select_configs
from docmart.session import delete_path, scratch_path
from docmart.sources.corpus import scan_directory
from docmart.sources.publish import Manifest, publish, read_published
from docmart.sources.tables import read_codemap
from docmart.sources.writers import WriteResult, write_csv_per_document, write_each


CODES = "-codes"


def build_table(
    parsed: DataFrame,
    table: str,
    configs: Sequence[DomainConfig],
    routing: Routing,
    codemap: DataFrame,
    parsed_for: Sequence[DomainConfig] | None = None,
    split_codes: bool = False,
) -> DataFrame:
    """One table from all of its configs: extract, look up, cast, align.

    Narrow but for the codemap join: no shuffle while the codemap is broadcast. With
    ``split_codes``, for larger ones, hot codes are counted and split off.
    """
    members = routing.tables(configs).get(table, [])
    if not members:
        raise ValueError(f"no config feeds table {table}")
    records = extract(parsed, members, parsed_for)
    return align(apply_lookups(records, members, codemap, split_codes), routing.schema(table))


def convert_table(
    corpus: DataFrame, table: str, configs: Sequence[DomainConfig], routing: Routing, codemap: DataFrame
) -> DataFrame:
    """A single table straight from the documents, in one pass, nothing stored.

    Only the elements this table needs are parsed.
    """
    members = routing.tables(configs).get(table, [])
    return build_table(parse_documents(corpus, members), table, members, routing, unique_codemap(codemap))


@dataclass
class Conversion:
    """A corpus parsed once and stored, and everything derived from it."""

    spark: SparkSession
    stage: str
    configs: list[DomainConfig]
    routing: Routing

    @property
    def codemap(self) -> DataFrame:
        """One concept per code, stored beside the documents: made once for all tables."""
        return self.spark.read.parquet(f"{self.stage}{CODES}")

    @property
    def parsed(self) -> DataFrame:
        return self.spark.read.parquet(self.stage)

    def table_names(self) -> list[str]:
        return list(self.routing.tables(self.configs))

    def table(self, name: str, split_codes: bool = False) -> DataFrame:
        return build_table(self.parsed, name, self.configs, self.routing, self.codemap, self.configs, split_codes)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.table_names()}

    def records(self, config: str) -> DataFrame:
        """Uncast records of one config, lookups resolved."""
        chosen = select_configs(self.configs, config)
        return apply_lookups(extract(self.parsed, chosen, self.configs), chosen, self.codemap)

    def quarantine(self) -> DataFrame:
        return quarantine(self.parsed)

    def status(self, written: Iterable[WriteResult] = ()) -> DataFrame:
        """Outcome per document and table. With the results of ``write`` a table that could not be
        written is an error of each of its documents."""
        failed = {r.name: r.error for r in written if r.error}
        return report.run_status(self.parsed, self.configs, self.routing, failed)

    def status_lines(self) -> DataFrame:
        return self.status().select(report.status_line().alias("line"))

    def shape_log(self) -> DataFrame:
        return report.shape_log(self.parsed, self.configs)

    def table_counts(self) -> DataFrame:
        return report.table_counts(self.parsed, self.configs, self.routing)

    def unmapped(self) -> DataFrame:
        """Configs that reach no table, with the rows that stay out."""
        counts = report.config_counts(self.parsed, self.configs)
        return unrouted(counts, routes_frame(self.spark, self.configs, self.routing))

    def write(self, base: str, fmt: str = "parquet", rows_per_file: int = 5_000_000) -> list[WriteResult]:
        """Write every table that has rows; isolate failures; remove what an earlier run left of
        declared tables that have none now.

        Rebalancing comes after the narrow part and is sized by AQE: extraction keeps the
        parallelism of the scan, and a small table is not one tiny file per split of it.
        """
        filled = self._filled()
        for name in self.table_names():
            if name not in filled:
                delete_path(self.spark, f"{base.rstrip('/')}/{name}.{fmt}")
        frames = {name: self.table(name).hint("rebalance") for name in filled}
        return write_each(frames, base, suffix=f".{fmt}", fmt=fmt, max_rows_per_file=rows_per_file, expected=filled)

    def _filled(self) -> dict[str, int]:
        """Tables with rows, and how many; one entry per declared table at most."""
        return {r["table"]: r["n"] for r in self.table_counts().collect()}

    def publish(self, base: str, run: str | None = None, rows_per_file: int = 5_000_000) -> Manifest:
        """Publish every table that has rows and the reports as one version (:mod:`docmart.sources.publish`);
        declared tables without rows are dropped from it. If one cannot be written, none is published."""
        frames = {name: self.table(name).hint("rebalance") for name in self._filled()}
        empty = [name for name in self.table_names() if name not in frames]
        reports = {"run_status": self.status(), "quarantine": self.quarantine(), "unmapped": self.unmapped()}
        return publish(frames | reports, base, run, drop=empty, max_rows_per_file=rows_per_file)

    def write_csv_per_document(self, base: str) -> None:
        """Records of every config, per document, below ``{base}/{config}``; for small corpora."""
        for config in self.configs:
            write_csv_per_document(self.records(config.name), f"{base.rstrip('/')}/{config.name}")

    def drop_stage(self) -> None:
        delete_path(self.spark, self.stage)
        delete_path(self.spark, f"{self.stage}{CODES}")


class RuleConversion(Conversion):
    """The same for documents whose records a user's function made."""

    @property
    def codemap(self) -> DataFrame:
        raise ValueError("a rule looks its codes up itself; see operators.lookup for doing it afterwards")

    def table(self, name: str) -> DataFrame:
        members = self.routing.tables(self.configs).get(name, [])
        if not members:
            raise ValueError(f"no config feeds table {name}")
        return align(rule_records(self.parsed, members), self.routing.schema(name))

    def records(self, config: str) -> DataFrame:
        return rule_records(self.parsed, select_configs(self.configs, config))


def convert_by_rule(
    corpus: DataFrame,
    rule: Rule,
    configs: Sequence[DomainConfig],
    routing: Routing,
    exclude_domains: Iterable[str] = (),
) -> RuleConversion:
    """Convert a corpus by a user's function (:mod:`docmart.operators.rules`); ``configs`` declare what
    it gives (``rule_config``). The function runs once a document: its records are stored in the
    shared work folder, and every table and report reads them there."""
    spark = corpus.sparkSession
    stage = scratch_path(spark, "by-rule", keep=True)
    run_rule(corpus, rule, configs).write.parquet(stage)
    return RuleConversion(spark, stage, list(configs), routing.select_domains(exclude=exclude_domains))


def convert_parsed(
    parsed: DataFrame,
    configs: Sequence[DomainConfig],
    routing: Routing,
    codemap: DataFrame,
    exclude_domains: Iterable[str] = (),
) -> Conversion:
    """Store documents parsed for exactly ``configs`` and derive every table from them.

    The stage is a Parquet table in the shared work folder rather than a cached
    frame: reading a table from it touches only that table's elements, nothing is
    parsed twice, and a lost executor costs no re-parse. Call ``drop_stage`` when
    done.
    """
    spark = parsed.sparkSession
    stage = scratch_path(spark, "parsed", keep=True)
    with_counts(parsed, configs).write.parquet(stage)
    unique_codemap(codemap).write.parquet(f"{stage}{CODES}")
    kept = routing.select_domains(exclude=exclude_domains)
    return Conversion(spark, stage, list(configs), kept)


def convert(
    corpus: DataFrame,
    configs: Sequence[DomainConfig],
    routing: Routing,
    codemap: DataFrame,
    only: Iterable[str] | str | None = None,
    exclude_domains: Iterable[str] = (),
) -> Conversion:
    """Convert a corpus of document texts; ``only`` names the configs to run."""
    chosen = select_configs(configs, only)
    return convert_parsed(parse_documents(corpus, chosen), chosen, routing, codemap, exclude_domains)


def convert_directory(
    spark: SparkSession,
    source: str,
    codemap_path: str,
    target: str,
    configs: Sequence[DomainConfig],
    routing: Routing,
    only: Iterable[str] | str | None = None,
    row_tag: str | None = None,
    id_path: str | None = None,
    publish_as: str | None = None,
) -> tuple[list[WriteResult], DataFrame]:
    """A folder of XML files to a folder of tables; returns what was written and the status.

    Each file is a document, or with ``row_tag`` each such element of the files,
    named by the text at ``id_path``. The results of the tables and of the reports are
    returned. The stage goes when all of them were written; if one was not, it is the only
    copy of what is missing, so it stays, and the status is read from it if need be.

    With ``publish_as``, the name of the run, the tables and reports become one version of ``target``
    instead of being written over those that are there; the same name again changes nothing.
    """
    codemap = read_codemap(spark, codemap_path)
    chosen = select_configs(configs, only)
    if row_tag:
        job = convert_parsed(read_documents(spark, source, row_tag, id_path, chosen), chosen, routing, codemap)
    else:
        job = convert(scan_directory(spark, source, require=True), chosen, routing, codemap)
    if publish_as is not None:
        made = job.publish(target, publish_as)
        job.drop_stage()
        status = read_published(spark, target, "run_status", made.number)
        tables = [WriteResult(n, f"{target.rstrip('/')}/{t.parts[-1].folder}", t.rows) for n, t in made.tables.items()]
        return tables, status.select("*", report.status_line().alias("line"))
    written: list[WriteResult] = []
    done = False
    try:
        written = job.write(target)
        status = job.status(written)
        base = f"{target.rstrip('/')}/_run"
        reports = {"run_status": status, "quarantine": job.quarantine(), "unmapped": job.unmapped()}
        written += write_each(reports, base)
        done = not any(r.error for r in written)
        if not any(r.error for r in written if r.name == "run_status"):
            status = spark.read.parquet(f"{base}/run_status.parquet")
    finally:
        if done:
            job.drop_stage()
    return written, status.select("*", report.status_line().alias("line"))
