"""Annotation analytics as Spark DataFrame operators.

The sub-packages follow the life of an annotation data set:

* ``functions``  column expressions (text, scores, agreement, JSON values)
* ``sources``    reading, validating, looking up and writing tables
* ``operators``  DataFrame to DataFrame operators
* ``plans``      session settings, test-table adapters, registered queries
"""
