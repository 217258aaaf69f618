"""Cash-ledger analytics as Spark DataFrame operators."""
