"""Registered queries over the driver tables, each with the SQL that must give the same rows.

The driver tables hold no package data, so they play roles: nation is the
organization, customer the package, orders the release, and so on. Role views
are ANSI SQL that both engines run; pages are rendered by Spark from the same
tables, row by row, and read back by the extraction rules.
"""
