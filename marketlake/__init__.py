"""Market-event lakehouse on PySpark: ingest, label, promote, aggregate and check stock-exchange events."""
