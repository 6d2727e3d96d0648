"""barlake: market-data tables, incremental upserts and canned analytics on Spark."""
