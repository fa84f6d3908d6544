"""DataFrame -> DataFrame building blocks: staging, facts, rollups, regions, upsert, quality."""
