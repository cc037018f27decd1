from cleanroll.sources.answers import answers
from cleanroll.sources.settings import read_settings
from cleanroll.sources.tables import JdbcTables, ParquetTables, TableSource

__all__ = ["JdbcTables", "ParquetTables", "TableSource", "answers", "read_settings"]
