"""Shot-event analytics on Spark: landed documents to marts, serving queries and checks."""
