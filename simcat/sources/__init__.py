from simcat.sources.tables import read_table
from simcat.sources.catalog import catalog_raw, RAW_COLUMNS
from simcat.sources.ldjson import scan_ldjson, malformed_count

__all__ = ["read_table", "catalog_raw", "RAW_COLUMNS", "scan_ldjson", "malformed_count"]
