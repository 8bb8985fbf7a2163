"""Where tables and messages go."""

from aeroflow.sinks.compaction import CompactingSink
from aeroflow.sinks.jdbc import JdbcSink
from aeroflow.sinks.parquet import ParquetSink
from aeroflow.sinks.topic import FileTopicSink, KafkaTopicSink, to_records

__all__ = ["CompactingSink", "FileTopicSink", "JdbcSink", "KafkaTopicSink", "ParquetSink", "to_records"]
