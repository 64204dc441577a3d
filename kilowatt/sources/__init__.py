"""Batch sources: parquet tables, CSV landing files, file inventories."""

from kilowatt.sources.files import (file_inventory, read_csv, read_table,  # noqa: F401
                                    with_provenance)
