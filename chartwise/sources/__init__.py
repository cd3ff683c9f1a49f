"""Readers and writers: raw chart CSV, result TSV, Parquet + catalog table,
and the raw-chart test fixture derived from the driver's tables."""
