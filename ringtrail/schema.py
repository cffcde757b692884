"""Column names and types of the records, the dictionaries and the enriched table."""

from __future__ import annotations

from pyspark.sql import types as T

# Positional fields of one delimited record, in order.
CDR_FIELDS = [
    ("start_time", "timestamp"),
    ("measuring_probe_name", "string"),
    ("imsi", "long"),
    ("msisdn", "long"),
    ("ms_ip_address", "string"),
    ("unique_cdr_id", "long"),
]

# Positional fields of one wide record, in order.
WIDE_CDR_FIELDS = [
    ("measuring_probe_name", "string"),
    ("start_time", "long"),
    ("procedure_duration", "long"),
    ("subscriber_activity", "string"),
    ("procedure_type", "long"),
    ("imsi", "long"),
    ("msisdn", "long"),
    ("apn", "string"),
    ("uri", "string"),
    ("ms_ip_address", "string"),
    ("total_data_ul", "long"),
    ("total_data_dl", "long"),
    ("mcc", "long"),
    ("mnc", "long"),
    ("imei", "string"),
    ("cgi", "long"),
    ("rat", "long"),
    ("host", "string"),
    ("tai_tac", "long"),
    ("lac", "long"),
    ("sac", "long"),
    ("cell_id", "long"),
    ("enb_id", "long"),
    ("event_type", "long"),
    ("source_ip", "string"),
    ("dest_ip", "string"),
    ("effective_throughput_dl", "long"),
    ("roaming_operator_name", "string"),
    ("roaming_direction", "string"),
    ("roaming_status", "long"),
    ("rtt", "long"),
    ("internet_latency", "double"),
    ("ran_latency", "double"),
    ("charging_type_name", "string"),
    ("protocol", "string"),
    ("release_cause", "long"),
    ("ttfb", "long"),
    ("mean_throughput_ul", "long"),
    ("mean_throughput_dl", "long"),
    ("peak_throughput_ul", "long"),
    ("peak_throughput_dl", "long"),
    ("effective_throughput_ul", "long"),
    ("unique_cdr_id", "long"),
    ("total_dl_raw_bytes", "long"),
    ("total_ul_raw_bytes", "long"),
    ("total_dl_tcp_bytes_no_retrans", "long"),
    ("total_ul_tcp_bytes_no_retrans", "long"),
    ("cell_region", "string"),
    ("tcp_retrans_frames_ratio_dl", "double"),
    ("tcp_retrans_frames_ratio_ul", "double"),
    ("total_dl_tcp_frames", "long"),
    ("total_ul_tcp_frames", "long"),
    ("total_dl_tcp_bytes", "long"),
    ("total_ul_tcp_bytes", "long"),
    ("tcp_retrans_bytes_ratio_dl", "double"),
    ("tcp_retrans_bytes_ratio_ul", "double"),
    ("total_ul_frames", "long"),
    ("total_dl_frames", "long"),
    ("application_name", "string"),
    ("rat_type_name", "string"),
    ("estimate_minimal_playout_time", "long"),
    ("video_total_duration", "long"),
    ("video_rebuffer_count", "long"),
    ("video_rebuffer_duration", "long"),
    ("video_resolution_duration_1", "long"),
    ("video_resolution_duration_2", "long"),
    ("video_resolution_duration_3", "long"),
    ("video_resolution_duration_4", "long"),
    ("avg_playout_vmos_score", "double"),
    ("total_dl_video_bytes", "long"),
    ("service_src_ip", "string"),
    ("service_dst_ip", "string"),
    ("src_ip_timestamps_list", "string"),
    ("dest_ip_timestamps_list", "string"),
    ("filter", "string"),
]

# Directory columns of the enriched table, outer first.
PARTITION_COLUMNS = ["event_date", "probe"]

# Dictionary columns, their types, and the names the joins use.
IMSI_DICTIONARY = [("imsi", "bigint", "_imsi"), ("msisdn", "bigint", "_msisdn")]
SESSION_DICTIONARY = [
    ("probe", "string", "_probe"),
    ("imsi", "bigint", "_imsi"),
    ("msisdn", "bigint", "_msisdn"),
    ("ms_ip_address", "string", "ms_ip_address"),
    ("start_time", "timestamp", "_start_time"),
]

# Read the table with this schema: left to guess, Spark turns probe "01" into the number 1.
ENRICHED_SCHEMA = T.StructType(
    [
        T.StructField("start_time", T.TimestampType()),
        T.StructField("measuring_probe_name", T.StringType()),
        T.StructField("imsi", T.LongType()),
        T.StructField("msisdn", T.LongType()),
        T.StructField("ms_ip_address", T.StringType()),
        T.StructField("unique_cdr_id", T.LongType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("probe", T.StringType()),
    ]
)
