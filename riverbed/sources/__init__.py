"""Sources: change scans, buffer reads, and configuration readers (session, shards, catalog)."""
