"""Writers: partitioned events, feature store, reports, upserts, exports and the ledger."""
