"""Reading and writing: configuration lists, snapshot tables, JDBC."""
