"""stellate: load wide, sparse, denormalised daily records into a star schema on Spark.

Everything is expressed with DataFrames, Spark SQL and Structured Streaming:

* ``sources``   -- text-typed CSV staging, header discovery, load audit
* ``functions`` -- column expressions: normalise, strict/lenient casts, completeness score
* ``operators`` -- dedup, latest-per-entity, table mapping/split, NULL-preserving merge,
                   distributed ordinal and key-range slices, constraint checks
* ``sinks``     -- staged writes, dynamic partition overwrite, bucketed targets
* ``plans``     -- the end-to-end load plan, its metrics and the derived test views
* ``streaming`` -- incremental upsert with ``foreachBatch``
"""

__version__ = "0.1.0"
