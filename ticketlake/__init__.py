"""Support-ticket lakehouse and retrieval on PySpark."""
