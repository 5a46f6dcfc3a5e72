"""tierline: tiered (bronze / silver / gold) ticket and event analytics on Spark.

Every operator is a plain function from DataFrame to DataFrame (or a column
expression), built from Spark SQL built-ins and Structured Streaming, so that
Catalyst can push filters and projections into the scans and whole-stage
codegen can fuse the rest.

Where things are:

* ``tierline.sources``   - landing/event JSON streams, guarded parquet, JDBC, ticket generator
* ``tierline.sinks``     - landing writer, keyed upsert and the bucketed target
* ``tierline.functions`` - triage rules, time helpers, repeatable picks
* ``tierline.operators`` - keys and rejects, column ops, dimension joins, gold aggregates
* ``tierline.streaming`` - starting and draining append streams
* ``tierline.plans``     - the jobs: bronze, silver (events, tickets), gold, the chain
* ``tierline.cli``       - spark-submit entry points for the jobs
"""

__version__ = "0.1.0"
