from tripstream.sources.tables import (
    read_parquet,
    read_csv_with_header,
    read_dimension_csv,
    read_json,
    sql_over_view,
)
from tripstream.sources.streams import json_file_stream, table_stream

__all__ = [
    "read_parquet",
    "read_csv_with_header",
    "read_dimension_csv",
    "read_json",
    "sql_over_view",
    "json_file_stream",
    "table_stream",
]
