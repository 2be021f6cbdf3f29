"""Document processing on Spark: text repair, layout, tables, routing, metadata, as DataFrame operations."""
