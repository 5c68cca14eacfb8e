"""starloom: load, check and query a partitioned star schema with PySpark.

The package is a set of ``DataFrame -> DataFrame`` and ``Column -> Column``
functions. Nothing here runs a job on import, and nothing passes table rows
through the driver.

* ``sources``    readers: delimited files, parquet periods, label texts, HTML, file names
* ``functions``  column expressions: dates, cleaning, text, ratios
* ``operators``  joins and lookups, name matching, keys, lists, profiles, data quality
* ``plans``      fact build, dimension builders, monthly load, analytic queries
* ``streaming``  load of period files as they arrive
"""

__version__ = "0.1.0"
