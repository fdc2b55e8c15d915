"""The registered queries of the library, their inputs made from the given tables, and their SQL."""
