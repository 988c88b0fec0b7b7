"""ledgerline: keyed message logs into versioned, partitioned tables, on Spark.

Everything here builds DataFrame / Spark SQL / Structured Streaming plans;
nothing runs per-row Python.  Sub-packages:

* ``functions`` - Column expressions (time fields, text cleaning, routing, casts)
* ``operators`` - DataFrame -> DataFrame operators (offsets, codec, chain, merge)
* ``sources``   - reading logs, offset logs and delimited text
* ``sinks``     - partitioned / versioned / delimited table writers
* ``plans``     - composite jobs (replay, publish, versioned merge)
* ``streaming`` - continuous ingest with an offset log
"""

__version__ = "0.1.0"
