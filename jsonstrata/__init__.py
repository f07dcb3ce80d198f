"""Layered JSON ingestion on Spark: messages in, RAW / CURATED / GOLD tables out."""
