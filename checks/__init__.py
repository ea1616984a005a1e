"""The registered queries: operators bound to the given tables, with SQL twins."""
