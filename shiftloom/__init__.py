"""shiftloom: workforce-schedule analytics on Spark DataFrames.

Sub-packages
------------
functions  column expressions (text, dates, rules)
sources    readers, writers and feed schemas
operators  DataFrame -> DataFrame transforms, used with ``df.transform(...)``
plans      the composite jobs: schedule fact, roster fact, feeds, snapshot
queries    the registered queries with their SQL counterparts
"""

__version__ = "0.1.0"
