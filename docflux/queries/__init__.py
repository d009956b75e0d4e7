"""Registered queries: name -> function of (spark, sf_dir), and name -> SQL that gives the same rows."""

from docflux.queries import catalogue, incremental, inventory, problems, reference

MODULES = [problems, reference, inventory, catalogue, incremental]
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}
