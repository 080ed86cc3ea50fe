"""The registered queries, their input views over the given tables, and the SQL they are checked with."""
