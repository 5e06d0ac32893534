from lakeseries.sources.bronze import bronze_glob, corrupt_documents, read_bronze, write_bronze
from lakeseries.sources.catalog import catalog_from_rows, read_catalog
from lakeseries.sources.tables import TableNotFoundError, read_table, write_table
from lakeseries.sources.work import remove, stored, work_path

__all__ = [
    "TableNotFoundError",
    "bronze_glob",
    "catalog_from_rows",
    "corrupt_documents",
    "read_bronze",
    "read_catalog",
    "read_table",
    "remove",
    "stored",
    "work_path",
    "write_bronze",
    "write_table",
]
