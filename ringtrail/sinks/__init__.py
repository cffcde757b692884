from ringtrail.sinks.tables import stream_to_table, write_batch, write_partitioned

__all__ = ["stream_to_table", "write_batch", "write_partitioned"]
