"""stepstone: prerequisite-graph analytics as PySpark DataFrame operators."""
