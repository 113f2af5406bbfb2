"""Packet sources: Kafka (S1-S5) and parquet files."""
