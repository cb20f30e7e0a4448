"""Writers: month-partitioned tables, relational appends, key-value entries, the run log."""
