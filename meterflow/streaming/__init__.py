from meterflow.streaming.job import StreamConfig, run_streams, start_queries
from meterflow.streaming.sinks import (
    checkpointed,
    read_batches,
    read_points,
    upsert_points,
    write_batches,
    write_console,
    write_kafka_stream,
)
