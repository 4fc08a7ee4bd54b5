"""The engine on a TPC-H-like star schema: raw tables, queries and their SQL."""
