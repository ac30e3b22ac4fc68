"""Trade-tick lakehouse transforms for PySpark.

Every transform is a ``DataFrame -> DataFrame`` function that works the same on
a batch and on a stream; sources and sinks are thin adapters around it.
"""

__version__ = "0.1.0"
