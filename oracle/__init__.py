"""DuckDB statements that state each registered query on the supplied tables."""

from oracle.build import with_tables
from oracle.statements import SQL

ORACLE = {name: with_tables(sql) for name, sql in SQL.items()}
