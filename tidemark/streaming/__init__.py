"""Event-time analytics: ingestion."""
