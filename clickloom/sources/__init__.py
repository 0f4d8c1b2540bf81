from clickloom.sources.files import order_events, read_table, receipt_events, replay
from clickloom.sources.kafka import decode_json, encode_json, kafka_options, read_kafka, write_kafka
from clickloom.sources.sinks import UpsertLog, append_files, by_outcome, console, each_batch, run_every, run_to_end
from clickloom.sources.tables import CompactTable

__all__ = [
    "CompactTable",
    "UpsertLog",
    "append_files",
    "by_outcome",
    "console",
    "decode_json",
    "each_batch",
    "encode_json",
    "kafka_options",
    "order_events",
    "read_kafka",
    "read_table",
    "receipt_events",
    "replay",
    "run_every",
    "run_to_end",
    "write_kafka",
]
