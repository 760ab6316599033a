"""Sources and sinks: delimited text with full-file typing, Parquet, dated
snapshots, JSON reports, schema description and warehouse tables."""

from tessera.sources.inference import TYPE_LATTICE, apply_types, infer_types
from tessera.sources.parquet import read_parquet, write_parquet
from tessera.sources.report import write_profile_json, write_profile_records
from tessera.sources.schema import describe, sql_type_name
from tessera.sources.snapshot import (
    read_snapshots,
    snapshot_path,
    write_snapshot,
)
from tessera.sources.tsv import read_text_table, read_tsv, read_tsv_staged
from tessera.sources.warehouse import layout_for_write, load_table, write_bucketed_table, write_partitioned

__all__ = [
    "TYPE_LATTICE",
    "apply_types",
    "describe",
    "infer_types",
    "layout_for_write",
    "load_table",
    "read_parquet",
    "read_snapshots",
    "read_text_table",
    "read_tsv",
    "read_tsv_staged",
    "snapshot_path",
    "sql_type_name",
    "write_bucketed_table",
    "write_parquet",
    "write_partitioned",
    "write_profile_json",
    "write_profile_records",
    "write_snapshot",
]
