"""fieldbook: a PySpark library for a product and strain catalogue.

Subpackages: ``sources`` (scans, sinks, snapshots), ``functions`` (column
expressions), ``operators`` (catalogue, ids, ingest, observations, search,
load, access), ``streaming`` (drop-folder ingest), ``plans`` (queries bound
to the test tables, with SQL oracles).
"""

__version__ = "0.1.0"
