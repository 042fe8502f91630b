"""Package-index metadata as Spark jobs: extract, clean, resolve, publish, query."""
