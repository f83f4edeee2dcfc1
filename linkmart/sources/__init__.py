"""Landing and reading page files, versioned Parquet tables, and testbed frames."""
