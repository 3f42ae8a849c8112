"""tidemark: event-time engagement analytics on Spark."""
