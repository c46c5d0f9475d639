"""The library on the given tables: mapped inputs, registered queries, SQL checks."""
