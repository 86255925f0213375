"""Readers and writers."""

from wardspan.sources.tables import (
    bundle_name,
    cdm_folder,
    empty_cdm,
    read_cdm,
    read_csv_lenient,
    read_csv_table,
    read_source,
    read_source_lenient,
    read_sources,
    read_vocabulary,
    read_vocabulary_text,
    vocab_tsv_to_parquet,
    write_cdm,
    write_table,
)

__all__ = [
    "bundle_name",
    "cdm_folder",
    "empty_cdm",
    "read_cdm",
    "read_csv_lenient",
    "read_csv_table",
    "read_source",
    "read_source_lenient",
    "read_sources",
    "read_vocabulary",
    "read_vocabulary_text",
    "vocab_tsv_to_parquet",
    "write_cdm",
    "write_table",
]
