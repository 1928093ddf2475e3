"""Sources and sinks: JDBC (S1/S2), file tables, previews (S3)."""

from .files import TABLES, materialize, read_table, table, write_table
from .jdbc import read_jdbc, write_jdbc
from .preview import head

__all__ = ["TABLES", "materialize", "read_table", "table", "write_table", "read_jdbc", "write_jdbc", "head"]
