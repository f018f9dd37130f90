"""Trip analytics as PySpark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``sources`` (readers, writers,
schemas), ``operators`` (DataFrame -> DataFrame), ``plans`` (operator compositions)
and ``streaming`` (Structured Streaming jobs).
"""
