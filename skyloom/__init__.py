"""Climate-event analytics on Spark."""
