"""Streams through keyed state, up to the rows a window takes."""

from __future__ import annotations

import zoneinfo

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from eduflow.operators import filters, projections, windows
from eduflow.operators.joins import Dims
from eduflow.plans import summaries
from eduflow.streaming import processors as P

# executors need no copy of this package: the processors travel with the query
cloudpickle.register_pickle_by_value(P)

VIEW = "source string, is_new string, ts bigint, uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint, et timestamp"
LOGIN = "ts bigint, user_count bigint, back_count bigint, et timestamp"


def _zone(df: DataFrame):
    return zoneinfo.ZoneInfo(df.sparkSession.conf.get("spark.sql.session.timeZone"))


def _through(rows: DataFrame, by: str, processor, schema, timed: bool = True, key: str | None = None) -> DataFrame:
    """Rows in state by `by`, which is the key, or puts keys of the column `key` into groups."""
    rows = filters.with_key(rows.where(F.col(key or by).isNotNull()), "ts", f"{key or by}_without_time")
    return rows.groupBy(by).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="EventTime" if timed else "None", **({"eventTimeColumnName": "et"} if timed else {}))


def _schema(rows: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])


def repair_new_flag(log: DataFrame) -> DataFrame:
    """`log` has `mid`, `is_new`, `ts` and any other columns."""
    return _through(log, "mid", P.VisitorFlag(zone=_zone(log)), _schema(log), timed=False)


def daily_visitors(pages: DataFrame, keep_ms: int | None = None) -> DataFrame:
    rows = pages.select("mid", "sc", "is_new", "last_page_id", "during_time", "ts", "et")
    return _through(rows, "mid", P.DailyVisitor(zone=_zone(pages), keep_ms=keep_ms), VIEW)


def daily_logins(pages: DataFrame, keep_ms: int | None = None) -> DataFrame:
    rows = pages.select("uid", "ts", "et")
    return _through(rows, "uid", P.DailyLogin(zone=_zone(pages), keep_ms=keep_ms), LOGIN)


#: Groups of keys that share one state row in corrections. A micro-batch reads and writes whole groups, so there are
#: many: with 36 million keys one holds about 550. Fixed, as a checkpoint holds keys by their group.
GROUPS = 1 << 16


def correct_repeats(facts: DataFrame, key: str, measures: list[str], window_ms: int,
                    keep_ms: int | None = None) -> DataFrame:
    """`facts` has typed measures, `ts` in milliseconds, `seq` and the watermarked `et`."""
    rows = facts.select(*[c for c in facts.columns if c not in ("ts", "et")], "ts", "et")
    processor = P.Correction(key, measures, window_ms, zone=_zone(facts), keep_ms=keep_ms)
    grouped = rows.withColumn(P.GROUP, F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(GROUPS))))
    return _through(grouped, P.GROUP, processor, _schema(rows), key=key)


def _corrected(facts: DataFrame, key: str, columns: list[str], measures: dict, window_ms: int, delay: str,
               keep_ms: int | None) -> DataFrame:
    typed = summaries.ordered(facts).select(
        *columns, *[m.alias(name) for name, m in measures.items()], (F.col("ts") * 1000).alias("ts"), "seq")
    return correct_repeats(filters.event_timed(typed, delay=delay), key, list(measures), window_ms, keep_ms)


ORDER_COLUMNS = ["id", "order_id", "user_id", "course_id", "course_name", "province_id", "sc"]


def measured(table: str, facts: DataFrame, dims: Dims | None, window_ms: int, delay: str = windows.DELAY,
             keep_ms: int | None = None) -> DataFrame:
    """The stream form of `plans.summaries.measured`, with a watermark on `et`.

    A key is remembered for ever, or with `keep_ms` for so long after its last row; keys that are
    then forgotten show as removed state rows in the query's progress.
    """
    job = summaries.JOBS[table]
    if job.measure in (summaries.course_orders, summaries.source_orders):
        if job.measure is summaries.source_orders:
            facts = filters.sourced_orders(facts)
        rows = _corrected(facts, "id", ORDER_COLUMNS, projections.order_measures(), window_ms, delay, keep_ms)
        if job.measure is summaries.source_orders:
            rows = rows.withColumnRenamed("sc", "source_id")
    elif job.measure is summaries.exam_papers:
        rows = _corrected(facts, "exam_id", ["exam_id", "paper_id", "user_id"], projections.exam_measures(),
                          window_ms, delay, keep_ms)
    elif job.measure is summaries.page_views:
        rows = daily_visitors(filters.event_timed(facts, delay=delay), keep_ms)
    elif table == "dws_user_user_login_window":
        rows = daily_logins(filters.event_timed(filters.known_users(facts), delay=delay), keep_ms)
    else:
        plain = job.measure(facts, dims) if job.needs_dims else job.measure(facts)
        # a row without a group key still tells that time has passed
        return summaries.keyed(table, filters.event_timed(plain, delay=delay))
    return summaries.keyed(table, rows)


def windowed(table: str, facts: DataFrame, dims: Dims | None = None, window_seconds: int = 5,
             delay: str = windows.DELAY, keep_ms: int | None = None) -> DataFrame:
    rows = measured(table, facts, dims, window_seconds * 1000, delay, keep_ms)
    return windows.summarise(rows, windows.SUMMARIES[table], f"{window_seconds} seconds")
