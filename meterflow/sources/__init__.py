from meterflow.sources.files import read_city_dim, read_json_dump, write_snapshot
from meterflow.sources.kafka import read_kafka_batch, read_kafka_stream
from meterflow.sources.store import read_hourly_store, write_hourly_store
