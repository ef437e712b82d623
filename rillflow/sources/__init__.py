"""Sources: driver tables (parquet), event streams, Kafka-shaped topic records."""

from rillflow.sources.records import TopicFolder, read_records
from rillflow.sources.tables import TABLES, event_stream, file_stream, read_table
from rillflow.sources.topics import (
    TOPIC_RECORD,
    read_topic,
    records_from_table,
    topic_values,
)

__all__ = ["TABLES", "read_table", "event_stream", "file_stream", "TOPIC_RECORD", "read_topic",
           "records_from_table", "topic_values", "TopicFolder", "read_records"]
