"""Sinks: message framing (Kafka / ordered message topics), database writer, state tables
(shadow, progress, metadata, seen ids) and files (skip location, dead letters, windowed export)."""
