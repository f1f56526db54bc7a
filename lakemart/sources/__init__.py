"""Sources, sinks and catalog helpers."""

from lakemart.sources.catalog import as_table, as_view, create_view, register_table, scan_periods
from lakemart.sources.drift import SchemaDrift, require_no_drift, schema_drift
from lakemart.sources.files import (period_path, preview, raw_inventory, read_delimited,
                                    read_inferred, read_period, write_csv, write_partitioned)
from lakemart.sources.inference import infer_types, merge_types, pin_schema, pinned_schema, read_pinned

__all__ = ["as_table", "as_view", "create_view", "register_table", "scan_periods", "period_path", "preview",
           "raw_inventory", "read_delimited", "read_inferred", "read_period", "write_csv",
           "write_partitioned", "SchemaDrift", "require_no_drift", "schema_drift", "infer_types", "merge_types",
           "pin_schema", "pinned_schema", "read_pinned"]
