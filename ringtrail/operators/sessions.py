"""The newest IP session at or before each record.

Records and sessions of one address are laid out on one time line, and the last session seen is
carried forward over it: one sort per address, never a pair of every record with every session.

An address may hold a large share of all rows, so its time line must not end up in one task. One
counting job finds the addresses with more than `hot_rows` rows. Only if there are any, their time
lines, records and sessions together, are cut into pieces of about `piece_rows` rows: Spark's range
partitioning takes the borders from quantiles of a sample. Records that are equal in address and time
are told apart by their place where they were read, so copies of one record are cut too. The last
session of each piece is then carried on to the pieces after it, one row per piece. This is exact: it
decides where rows are processed, not what comes out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.storage import work_folder

ADDRESS = ["probe", "ip"]

HOT_ROWS = 1_000_000
PIECE_ROWS = 1_000_000


def _preference() -> Column:
    """Order among sessions of one address and start time: lowest IMSI, then MSISDN, NULLs last."""
    return F.struct(
        F.col("_imsi").isNull().alias("no_imsi"),
        F.col("_imsi"),
        F.col("_msisdn").isNull().alias("no_msisdn"),
        F.col("_msisdn"),
    )


def distinct_sessions(sessions: DataFrame) -> DataFrame:
    """The preferred session per address and start time.

    Sessions without probe or start time match no record and are left out. The minimum is taken on
    the map side first, so repeated sessions are not shuffled.
    """
    return (
        sessions.filter(F.col("_probe").isNotNull() & F.col("_start_time").isNotNull())
        .groupBy("_probe", "_ip", "_start_time")
        .agg(F.min(_preference()).alias("first"))
        .select("_probe", "_ip", "_start_time", "first._imsi", "first._msisdn")
    )


def newest_session(
    records: DataFrame,
    sessions: DataFrame,
    hot_rows: int | None = HOT_ROWS,
    piece_rows: int = PIECE_ROWS,
    look_back_seconds: int | None = None,
) -> DataFrame:
    """Left outer as-of join: add `_imsi, _msisdn, _start_time` of the newest session whose probe
    and address are equal and whose start is not after the record.

    `records` has one row per record and address (`ip`); every one of them comes back once. The
    counting job for hot addresses, and where there are any the cutting of their time lines, run when
    this is called; `hot_rows=None` leaves both out, for inputs known to be small.

    A session matches however old it is, or for `look_back_seconds` if given. Sessions too old for
    the earliest record, which a further job finds, then go before anything is shuffled.
    """
    if look_back_seconds is not None:
        sessions = _recent(sessions, records, look_back_seconds)
    payload = [name for name in records.columns if name not in [*ADDRESS, "start_time"]]
    arrivals = records.select(
        *ADDRESS,
        F.col("start_time").alias("at"),
        F.struct(*[F.col(name) for name in payload]).alias("record"),
    )
    hot = None if hot_rows is None else _hot_addresses(arrivals, sessions, hot_rows)
    starts = _starts(sessions)
    time_line = arrivals.withColumns(
        {"piece": _spread(F.lit(-1)), "session": F.lit(None)}
    ).unionByName(starts.withColumns({"piece": F.lit(-1), "record": F.lit(None)}))
    if hot is not None:
        total = hot.agg(F.sum("rows")).first()[0]
        if total:
            pieces = _pieces(arrivals, _starts(distinct_sessions(sessions)), hot, -(-total // piece_rows))
            time_line = _of_addresses(time_line, hot, "left_anti").unionByName(pieces)
    line = [*ADDRESS, "piece"]

    # A session that starts at the time of a record counts for it, so records come after sessions.
    # Of sessions that start together the preferred one comes last and is the one carried on.
    so_far = (
        Window.partitionBy(*line)
        .orderBy("at", F.col("record").isNotNull(), F.desc("session.preference"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = time_line.withColumn("session", F.last("session", ignorenulls=True).over(so_far))
    if look_back_seconds is not None:
        age = F.unix_micros("at") - F.unix_micros("session._start_time")
        carried = carried.withColumn(
            "session", F.when(age <= look_back_seconds * 1_000_000, F.col("session"))
        )
    return (
        carried.filter(F.col("record").isNotNull())
        .select(*ADDRESS, F.col("at").alias("start_time"), "record.*", "session")
        .select(
            *records.columns,
            "session.preference._imsi",
            "session.preference._msisdn",
            "session._start_time",
        )
    )


def _recent(sessions: DataFrame, records: DataFrame, look_back_seconds: int) -> DataFrame:
    earliest = records.agg(F.min(F.unix_micros("start_time"))).first()[0]
    if earliest is None:
        return sessions.limit(0)
    since = earliest - look_back_seconds * 1_000_000
    return sessions.filter(F.col("_start_time") >= F.timestamp_micros(F.lit(since)))


def pick_latest(matched: DataFrame) -> DataFrame:
    """One row per `unique_cdr_id`: the one with the newest session, unmatched rows last.

    Rows without an id count as one id. The order goes on over all remaining columns, so a task
    that is run again picks the same row. Spark keeps the best row of each task before it shuffles,
    so an id with very many copies stays small.
    """
    leading = ["_start_time", "start_time", "ip", "_imsi", "_msisdn"]
    rest = [name for name in matched.columns if name not in [*leading, "unique_cdr_id"]]
    newest_first = Window.partitionBy("unique_cdr_id").orderBy(
        F.desc_nulls_last("_start_time"),
        F.desc_nulls_last("start_time"),
        *[F.asc_nulls_last(name) for name in [*leading[2:], *rest]],
    )
    return (
        matched.withColumn("rank", F.row_number().over(newest_first))
        .filter(F.col("rank") == 1)
        .drop("rank")
    )


def _hot_addresses(arrivals: DataFrame, sessions: DataFrame, hot_rows: int) -> DataFrame:
    """address (a hash), rows of all addresses with more than `hot_rows` rows, as a stored table.

    Rows are counted on the map side first. Two addresses that share a hash are treated alike,
    which is exact either way. As a stored table its size is known, so Spark broadcasts it while it
    is small; nothing of it comes to the driver.
    """
    keys = arrivals.filter(F.col("probe").isNotNull() & F.col("at").isNotNull()).select(*ADDRESS)
    session_keys = sessions.select(F.col("_probe").alias("probe"), F.col("_ip").alias("ip"))
    heaviest = (
        keys.unionByName(session_keys.filter(F.col("probe").isNotNull()))
        .groupBy(F.xxhash64(*ADDRESS).alias("address"))
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > hot_rows)
    )
    return _stored(heaviest, "hot")


def _stored(rows: DataFrame, purpose: str) -> DataFrame:
    where = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(where)
    return rows.sparkSession.read.schema(rows.schema).parquet(where)


def _of_addresses(rows: DataFrame, hot: DataFrame, how: str) -> DataFrame:
    """Rows whose address is hot (`left_semi`) or is not (`left_anti`). Records that cannot match are
    on no time line, whatever their address."""
    key = F.when(F.col("probe").isNotNull() & F.col("at").isNotNull(), F.xxhash64(*ADDRESS))
    return rows.withColumn("address", key).join(hot.select("address"), "address", how).drop("address")


def _spread(shared: Column) -> Column:
    """`shared`, but for records that cannot match (no probe or no time): they have no time line
    in common, so they stay with the task that read them."""
    return F.when(
        F.col("probe").isNull() | F.col("at").isNull(), F.spark_partition_id()
    ).otherwise(shared)


def _starts(sessions: DataFrame) -> DataFrame:
    return sessions.filter(
        F.col("_probe").isNotNull() & F.col("_start_time").isNotNull()
    ).select(
        F.col("_probe").alias("probe"),
        F.col("_ip").alias("ip"),
        F.col("_start_time").alias("at"),
        F.struct(_preference().alias("preference"), "_start_time").alias("session"),
    )


def _pieces(arrivals: DataFrame, starts: DataFrame, hot: DataFrame, count: int) -> DataFrame:
    """The time lines of hot addresses in `count` pieces, each of which begins with the last session
    of its address in earlier pieces.

    Pieces are written once, as only a stored piece is the same each time it is read.
    """
    rows = arrivals.withColumns(
        {"turn": F.monotonically_increasing_id(), "session": F.lit(None)}
    ).unionByName(starts.withColumns({"turn": F.lit(-1), "record": F.lit(None)}))
    # Sessions have no turn, so they come before the records of the same time.
    cut = (
        _of_addresses(rows, hot, "left_semi")
        .repartitionByRange(count, *ADDRESS, "at", "turn")
        .drop("turn")
        .withColumn("piece", F.spark_partition_id())
    )
    cut = _stored(cut, "pieces")
    last = cut.groupBy(*ADDRESS, "piece").agg(F.max_by("session", F.when(F.col("session").isNotNull(), F.col("at"))).alias("last"))
    # One row per address and piece: an address has no more of them than it has pieces.
    before = Window.partitionBy(*ADDRESS).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("session", F.last("last", ignorenulls=True).over(before)).filter(
        F.col("session").isNotNull()
    )
    seeds = carried.select(
        *ADDRESS, "piece", F.col("session._start_time").alias("at"), "session", F.lit(None).alias("record")
    )
    return cut.unionByName(seeds)
