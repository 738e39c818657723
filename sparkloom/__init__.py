"""sparkloom: Spark-first data conformance, change tracking and analytics operators."""
