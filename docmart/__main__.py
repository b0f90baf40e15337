"""Job entry: ``spark-submit`` this module, or ``python -m docmart``.

    python -m docmart --input DIR --output DIR --codemap map.csv --declarations pkg.module

The declarations module defines ``CONFIGS`` and ``ROUTING``.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from docmart.operators.report import error_histogram, status_counts
from docmart.plans.pipeline import convert_directory
from docmart.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="docmart", description=__doc__)
    parser.add_argument("--input", required=True, help="folder of *.xml documents")
    parser.add_argument("--output", required=True, help="folder of the tables")
    parser.add_argument("--codemap", required=True, help="CSV: code_system, code, concept_id")
    parser.add_argument("--declarations", required=True, help="module with CONFIGS and ROUTING")
    parser.add_argument("--only", nargs="*", default=None, help="names of configs to run")
    parser.add_argument("--row-tag", help="element that is a document, in files of many documents")
    parser.add_argument("--id-path", help="with --row-tag: path of the document id, such as id._extension")
    parser.add_argument("--publish-as", help="name of the run: publish all tables as one version of the output folder")
    args = parser.parse_args(argv)
    if bool(args.row_tag) != bool(args.id_path):
        parser.error("--row-tag and --id-path go together")

    declared = importlib.import_module(args.declarations)
    spark = build_session()
    written, status = convert_directory(
        spark,
        args.input,
        args.codemap,
        args.output,
        declared.CONFIGS,
        declared.ROUTING,
        args.only,
        args.row_tag,
        args.id_path,
        args.publish_as,
    )
    for result in written:
        print(f"{result.name}: {result.error or f'{result.rows} rows'} -> {result.path}")
    status_counts(status).show()
    error_histogram(status).show(truncate=False)
    return 1 if any(r.error for r in written) else 0


if __name__ == "__main__":
    sys.exit(main())
