"""Sources and sinks: raw files, layer tables, and driver-table adapters."""

from crease.sources.adapters import deliveries_from_lineitem, matches_from_orders
from crease.sources.files import ingest, read_table, with_audit, write_table
from crease.sources.tables import expire, versions

__all__ = ["deliveries_from_lineitem", "expire", "ingest", "matches_from_orders", "read_table",
           "versions", "with_audit", "write_table"]
