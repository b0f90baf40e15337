"""Semi-structured clinical documents to typed tables, on Spark."""

from docmart.plans.config import (
    DomainConfig,
    Field,
    Routing,
    Step,
    code_lookup,
    constant,
    document_id,
    from_document,
    from_path,
    from_step,
    position,
    select_configs,
)
from docmart.plans.pipeline import (
    Conversion,
    build_table,
    convert,
    convert_directory,
    convert_parsed,
    convert_table,
)
from docmart.session import build_session

__all__ = [
    "Conversion",
    "DomainConfig",
    "Field",
    "Routing",
    "Step",
    "build_session",
    "build_table",
    "code_lookup",
    "constant",
    "convert",
    "convert_directory",
    "convert_parsed",
    "convert_table",
    "document_id",
    "from_document",
    "from_path",
    "from_step",
    "position",
    "select_configs",
]
