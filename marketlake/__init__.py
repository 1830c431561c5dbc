"""Market-data lakehouse operators for PySpark.

``functions``  column expressions (text, numbers, dates, HTML fields)
``operators``  DataFrame transforms and table loads
``sources``    lake files: readers, partitioned writes, compaction
``streaming``  incremental ingest of new files
``plans``      whole jobs made of the above
"""

__version__ = "0.1.0"
