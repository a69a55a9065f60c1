"""Spark-native engine for open address data.

Sub-packages
------------
functions   column expressions (conform compiler, geometry, text, licences)
operators   DataFrame -> DataFrame operators (filters, joins, aggregates, ...)
sources     readers and writers
plans       whole jobs composed from the operators
streaming   Structured Streaming versions of the event rules
catalog     bindings of every operator to the test tables, with check SQL
"""

__version__ = "0.1.0"
