from .jdbc import JdbcEndpoint, jdbc_table
from .streams import file_stream, kafka_options, kafka_stream, table_stream
from .tables import parquet_table

__all__ = [
    "JdbcEndpoint",
    "file_stream",
    "jdbc_table",
    "kafka_options",
    "kafka_stream",
    "parquet_table",
    "table_stream",
]
