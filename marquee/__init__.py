"""marquee: daily and streaming ELT operators on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that runs on the executors. Sub-packages:

* ``functions`` - column expressions (surrogate keys, casts, null handling, one-hot names)
* ``operators`` - joins, dimensions, SCD2 snapshots, data-quality suites
* ``sources``   - readers, writers, id registry, catalog and materialization
* ``plans``     - composed models (staging, dims, fact) and the daily run
* ``streaming`` - Structured Streaming forms of ingest, dedup and snapshots
"""

from marquee.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
