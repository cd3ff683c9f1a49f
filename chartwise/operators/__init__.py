"""DataFrame -> DataFrame steps; all lazy, all built from Spark built-ins."""
