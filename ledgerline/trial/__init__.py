"""The registered queries: the library's operators over the given tables, and the SQL that checks them."""
