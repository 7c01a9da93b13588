"""serplens: search-performance and page-metadata analytics on PySpark.

Operators take and return DataFrames. Tables, files and directories are touched
only in :mod:`serplens.sources` and :mod:`serplens.plans`.
"""

__version__ = "0.1.0"
