"""Sinks: idempotent foreachBatch writers (file, JDBC), webhook, SQL surface."""
