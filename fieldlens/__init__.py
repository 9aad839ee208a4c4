"""The warehouse and sheet tables of the library, seen through the TPC-H-like test tables.

Test scaffolding: the library itself does not depend on it.
"""
