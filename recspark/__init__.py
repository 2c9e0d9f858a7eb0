"""PySpark operators for versioned, hierarchical records."""
