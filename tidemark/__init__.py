"""Tidemark: customer, subscription and revenue analytics as plain Spark DataFrame functions.

Every public function takes DataFrames or Columns and returns DataFrames or Columns.  Nothing runs
until the caller asks for rows, except where a docstring says that a function reads data at once.
"""

__version__ = "0.1.0"
