"""Writers: staging tables, exports, partitioned ledgers, upserts."""
