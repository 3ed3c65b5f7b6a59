"""Relations the reports read: explicit schemas, parquet/catalog loaders, test derivation."""

from .derive import DriverTables, derive_tables
from .schema import RELATIONS, SCHEMAS
from .tables import FinanceTables, empty_strings_as_null

__all__ = ["DriverTables", "derive_tables", "RELATIONS", "SCHEMAS", "FinanceTables", "empty_strings_as_null"]
