"""Sales-operations analytics on Spark: ledger, dimensions, field KPIs, marts."""
