"""Social-indicator analytics as Spark DataFrame operators.

functions  column expressions (no Python UDF)
operators  DataFrame -> DataFrame steps
sources    readers, layer tables, period loads
plans      rule packs, cleaners and end-to-end results
streaming  file-stream form of the period load
bindings   the checked queries used by ``__spark_entry__``
"""
