"""balancete: fiscal ledger and income-statement jobs on Spark.

Layers:
  functions/  Column expressions (blank/NULL rules, date codec, percent parser)
  sources/    table schemas, Parquet readers, stand-ins built from driver tables,
              invoice-XML reader and the CSV sink
  operators/  lookups, GL side (balances, journal, exclusion, allocation),
              document side (sales, returns, DIFAL, PIS/COFINS), invoice flattening
  plans/      period parameters, configuration and rule tables, ledger union,
              income statement
  streaming/  incremental invoice-folder ingestion with Structured Streaming
"""

__version__ = "0.1.0"
