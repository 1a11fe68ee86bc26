from .bronze import latest_file_only, read_bronze_json, read_bronze_parquet
from .sinks import replace_table, write_json, write_parquet, write_text
from .store_feed import StoreApi, StoreFeedSource, http_transport, replay_transport

__all__ = [
    "StoreApi", "StoreFeedSource", "http_transport", "latest_file_only", "read_bronze_json", "read_bronze_parquet",
    "replace_table", "replay_transport", "write_json", "write_parquet", "write_text",
]
