"""DataFrame-in / DataFrame-out operators of the replication toolkit."""
