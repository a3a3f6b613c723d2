"""quotelake: market-quote analytics expressed with public PySpark APIs.

Layout:
  schemas      record and table contracts (StructType constants)
  session      session settings and the shared working folder
  sources/     readers: lake parquet, envelope streams (Kafka or files), JDBC, adapters
  functions/   column expressions: flags, categories, parsing, envelopes
  operators/   DataFrame -> DataFrame operators: stats, latest-per-key, contracts, gates
  plans/       dashboard questions composed from the operators
  sinks/       parquet lake, JDBC tables, run log
  streaming/   Structured Streaming jobs built on the same operators
"""

__version__ = "0.1.0"
