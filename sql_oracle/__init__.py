"""DuckDB oracle SQL, written from the reference's SQL independently of the
DataFrame code. The driver's tables are views; the raw layer (FIXTURES.md) is
inlined as CTEs."""
