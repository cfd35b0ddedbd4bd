"""Reading and writing: JSON lines, JDBC, catalog tables, report files."""
