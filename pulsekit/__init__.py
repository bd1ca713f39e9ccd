"""pulsekit: minute-level sensor series and activity intervals on Spark.

Every operator is a plain function ``DataFrame (+ params) -> DataFrame`` built
from the DataFrame / SQL API, so Catalyst plans, prunes and pushes down as
usual.  Sub-packages:

* ``sources``    explicit schemas, readers and writers, landing and incremental selection
* ``functions``  column expressions (time text, keys, one-hot, markers)
* ``operators``  flattening, labelling, rollups, lag features, series, tracks, model
* ``plans``      stand-in inputs over the shared tables and the query registry
* ``streaming``  file-source ingestion with Structured Streaming
"""

__version__ = "0.1.0"
