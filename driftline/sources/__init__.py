from driftline.sources.records import (
    RECORD_SCHEMA, record_frame, topic_filter, slice_from_offsets, read_records,
    read_record_stream, kafka_records,
)

__all__ = ["RECORD_SCHEMA", "record_frame", "topic_filter", "slice_from_offsets",
           "read_records", "read_record_stream", "kafka_records"]
