"""Structured Streaming operators: ordered release buffer, out-of-order guard, windows,
id de-duplication, and the polling (foreachBatch) runner."""
