"""End-to-end plans and the registry of named queries with their SQL oracles."""
