"""The same results in DuckDB SQL."""

from __future__ import annotations

from ringtrail.schema import WIDE_CDR_FIELDS
from workload import feed
from workload.catalog import PLAN_TARGET_BYTES

CDR = """
select try_cast(a[1] as timestamp) start_time, a[2] measuring_probe_name,
 try_cast(a[3] as bigint) imsi, try_cast(a[4] as bigint) msisdn, a[5] ms_ip_address,
 try_cast(a[6] as bigint) unique_cdr_id,
 strftime(try_cast(a[1] as timestamp), '%Y-%m-%d') event_date, substring(a[2], 1, 2) probe
from (select string_split(value, ',') a from cdr_raw)
"""

SESSIONS = """
select * from (
 select probe _probe, imsi _imsi, msisdn _msisdn, start_time _start_time,
  trim(unnest(string_split(trim(ms_ip_address), ';'))) _ip
 from ms_ip)
where _ip <> ''
"""

# One session per address and start time, so that ASOF has nothing to choose between.
DISTINCT_SESSIONS = """
select * from sessions
qualify row_number() over (partition by _probe, _ip, _start_time
 order by _imsi nulls last, _msisdn nulls last) = 1
"""

IDENTIFIED = """
select * from cdr where imsi is not null and cast(imsi as varchar) not like '999%'
"""

UNIDENTIFIED = """
select * from cdr where imsi is null or cast(imsi as varchar) like '999%'
"""

EXPLODED = """
select * from (
 select *, trim(unnest(string_split(trim(ms_ip_address), ';'))) ip from {source})
where ip <> ''
"""

CANDIDATES = """
select e.*, _imsi, _msisdn, _start_time
from unidentified_ips e asof left join distinct_sessions s
 on e.probe = s._probe and e.ip = s._ip and e.start_time >= s._start_time
"""

PICKED = """
select * from candidates
qualify row_number() over (partition by unique_cdr_id
 order by _start_time desc nulls last, start_time desc nulls last, ip nulls last,
  _imsi nulls last, _msisdn nulls last, measuring_probe_name nulls last, imsi nulls last,
  msisdn nulls last, ms_ip_address nulls last, event_date nulls last, probe nulls last) = 1
"""

BY_IMSI = """
select c.* replace (coalesce(d.msisdn, c.msisdn) as msisdn)
from identified c left join imsi_msisdn d on c.imsi = d.imsi
"""

BY_IP = """
select * exclude (ip, _imsi, _msisdn, _start_time)
 replace (coalesce(_imsi, imsi) as imsi, coalesce(_msisdn, msisdn) as msisdn)
from picked
"""

ALL = "select * from by_imsi union all select * from by_ip"


def _wide_column(position: int, name: str, kind: str) -> str:
    text = f"a[{position + 1}]"
    types = {"long": "bigint", "double": "double"}
    value = f"try_cast({text} as {types[kind]})" if kind in types else text
    return f'{value} "{name}"'


def _wide(event_time: bool) -> str:
    columns = [_wide_column(i, name, kind) for i, (name, kind) in enumerate(WIDE_CDR_FIELDS)]
    rows = f"select {', '.join(columns)} from (select string_split(value, ',') a from wide_raw)"
    if not event_time:
        return rows
    return f"""
    select * replace (make_timestamp(start_time * 1000) as start_time),
     strftime(make_timestamp(start_time * 1000), '%Y-%m-%d') event_date,
     substring(measuring_probe_name, 1, 2) probe
    from ({rows})"""


def _with(result: str, records: str = CDR) -> str:
    """`result` over the steps above; DuckDB only runs those that it uses."""
    steps = {
        "cdr_raw": feed.CDR_RAW.format(timestamp=feed.DUCKDB_TIMESTAMP),
        "wide_raw": feed.wide_raw_sql(feed.DUCKDB_MILLIS),
        "imsi_msisdn": feed.IMSI_MSISDN,
        "ms_ip": feed.MS_IP,
        "cdr": records,
        "sessions": SESSIONS,
        "distinct_sessions": DISTINCT_SESSIONS,
        "identified": IDENTIFIED,
        "unidentified": UNIDENTIFIED,
        "cdr_ips": EXPLODED.format(source="cdr"),
        "unidentified_ips": EXPLODED.format(source="unidentified"),
        "candidates": CANDIDATES,
        "picked": PICKED,
        "by_imsi": BY_IMSI,
        "by_ip": BY_IP,
        "enriched": ALL,
    }
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in steps.items()) + f"\n{result}"


def _wide_enriched() -> str:
    # A repeated id takes the lowest of each further column in order, as the Spark side does.
    rest = [name for name, _ in WIDE_CDR_FIELDS if name not in ("start_time", "unique_cdr_id")]
    order = ", ".join(f'"{name}" nulls last' for name in [*rest, "event_date", "probe"])
    picked = f"""
    select * from candidates
    qualify row_number() over (partition by unique_cdr_id
     order by _start_time desc nulls last, start_time desc nulls last, ip nulls last,
      _imsi nulls last, _msisdn nulls last, {order}) = 1"""
    return _with("select * from enriched", _wide(True)).replace(PICKED, picked)


ENRICHED = _with("select * from enriched")

ORACLES: dict[str, str] = {
    "parse_cdr": _with("select * from cdr"),
    "parse_wide": _with(_wide(False)),
    "explode_cdr_ips": _with("select * from cdr_ips"),
    "explode_session_ips": _with("select * from sessions"),
    "identified": _with("select * from identified"),
    "unidentified": _with("select * from unidentified"),
    "join_imsi_left": _with(
        "select c.*, d.imsi _imsi, d.msisdn _msisdn "
        "from identified c left join imsi_msisdn d on c.imsi = d.imsi"
    ),
    "enrich_by_imsi": _with("select * from by_imsi"),
    "session_candidates": _with("select * from candidates"),
    "pick_latest_session": _with("select * from picked"),
    "enrich_by_ip": _with("select * from by_ip"),
    "enrich_by_ip_sliced": _with("select * from by_ip"),
    "enrich": ENRICHED,
    "enrich_wide": _wide_enriched(),
    "stream_enrich": ENRICHED,
    "stream_two_checkpoints": _with("select * from enriched union all select * from enriched"),
    "unroutable": _with(
        "select * from unidentified where coalesce(len(list_filter("
        "string_split(trim(ms_ip_address), ';'), lambda ip: trim(ip) <> '')), 0) = 0"
    ),
    "compact_mixed_columns": _with(
        "select event_date, nullif(probe, '') probe, count(*) as rows,"
        " count(*) filter (unique_cdr_id % 2 <> 0) extras from cdr group by all"
    ),
    "compact_mixed_types": _with(
        "select event_date, nullif(probe, '') probe,"
        " count(*) filter (dayofyear(event_date::date) % 10 <> 0) as rows,"
        " (sum(unique_cdr_id) filter (dayofyear(event_date::date) % 10 <> 0))::bigint total,"
        " case when dayofyear(any_value(event_date)::date) % 10 = 0 then 'string' end found"
        " from cdr where event_date is not null group by event_date, probe"
    ),
    "stream_identified": _with("select * from by_imsi"),
    "partitioned_roundtrip": ENRICHED,
    "imsi_dictionary_read": _with("select imsi _imsi, msisdn _msisdn from imsi_msisdn"),
    "session_dictionary_read": _with(
        "select probe _probe, imsi _imsi, msisdn _msisdn, ms_ip_address, start_time _start_time "
        "from ms_ip"
    ),
    "compaction_plan": f"""
select lang, source, cast(sum(n_chars) as bigint) bytes,
 cast(ceil(greatest(sum(n_chars) * cast(1.2 as double), {PLAN_TARGET_BYTES}.0::double)
  / {PLAN_TARGET_BYTES}.0::double) as integer) n_out
from documents group by lang, source
""",
    "compaction_inventory": _with(
        "select event_date, nullif(probe, '') probe,"
        " count(distinct coalesce(unique_cdr_id % 2 <> 0, false)) files, true has_bytes"
        " from enriched group by all"
    ),
    "compact_files": _with(
        "select event_date, nullif(probe, '') probe, count(*) as rows, true fits"
        " from enriched group by all"
    ),
    "compact_incremental": _with("select * from enriched union all select * from enriched"),
    "compact_roundtrip": ENRICHED,
    "compact_move": ENRICHED,
    "latest_progress": """
select 'latest_progress' as name, cast(0 as bigint) batch_id, count(*) num_input_rows from events
""",
    "dictionary_refresh": _with(
        "select phase, imsi _imsi, msisdn + later _msisdn from imsi_msisdn, "
        "(values ('first read', 0), ('within ttl', 0), ('after ttl', 1)) t(phase, later)"
    ),
}
