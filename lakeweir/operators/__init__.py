"""Table-level operators: joins, averages, duplicate removal, row counts."""
