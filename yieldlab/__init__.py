"""yieldlab: yield and quality analytics over wide sensor data on Spark.

Subpackages:

* ``sources``    text/label loaders, table writers, model store
* ``functions``  scalar column expressions
* ``operators``  ordering helpers, cleaning, split, metrics, model, attribution
* ``plans``      analytical views, data-quality checks, test-data adapters,
                 the query catalog and the end-to-end run
* ``streaming``  incremental daily KPIs with Structured Streaming
"""

__version__ = "0.1.0"
