"""Registered queries: operators of ``vacantia`` bound to the given tables, with SQL to check them."""
