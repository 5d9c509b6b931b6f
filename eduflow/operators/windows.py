"""Tumbling event-time summaries. The same code serves tables and streams."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from eduflow.functions import values as V

LENGTH = "5 seconds"
DELAY = "3 seconds"

DEVICE_ORDER = ["ts", "last_page_id", "sc", "is_new"]


@dataclass(frozen=True)
class Summary:
    """Keys, summed columns and distinct counts of one summary table.

    `distinct` maps a result to a member column, or to (member column, flag column) where only
    flagged rows count. `name` is a column whose earliest value in the window is kept.
    """

    keys: list[str] = field(default_factory=list)
    sums: list[str] = field(default_factory=list)
    distinct: dict[str, str | tuple[str, str]] = field(default_factory=dict)
    name: str | None = None


def _member(spec) -> tuple[str, Column]:
    if isinstance(spec, str):
        return spec, F.lit(1)
    return spec[0], F.when(F.col(spec[1]) > 0, 1).otherwise(0)


def summarise(rows: DataFrame, spec: Summary, length: str = LENGTH) -> DataFrame:
    """Window `rows` by `et`.

    Distinct counts are exact and hold no sets: rows are first reduced to one per member, spread
    over all tasks by member, and then counted. A missing member counts as one member. Names are
    members too: text in an aggregate's buffer would make it sort, so a name stays a group key
    until few rows are left, and only then the earliest is picked.
    """
    rows, named = _timed(rows, length), [spec.name] if spec.name else []
    if spec.distinct:
        grouped = _per_member(rows, spec)
    else:
        grouped = rows.groupBy(TIME, *spec.keys, *[F.col(n).alias("name") for n in named]).agg(
            *[F.sum(c).alias(c) for c in spec.sums], *[F.min("ts").alias("at") for _ in named])
    if named:
        # rows that carry no name have no `at`, and a null sorts behind any time here
        earliest = F.min(F.struct(F.col("at").isNull(), "at", "name"))["name"]
        grouped = grouped.groupBy(TIME, *spec.keys).agg(
            *[F.sum(c).alias(c) for c in [*spec.sums, *spec.distinct]], earliest.alias(spec.name))
    return _bounds(grouped.withColumn("window", F.window(TIME, length)), spec)


#: A window in group keys: its last microsecond, a quarter of the window's own size. A stream closes it as its window.
TIME = "window_time"


def _timed(rows: DataFrame, length: str) -> DataFrame:
    """The rows with the last microsecond of their window; rows without a time have no window."""
    return rows.withColumn("window", F.window("et", length)).withColumn(TIME, F.window_time("window")).drop("window")


def _per_member(rows: DataFrame, spec: Summary) -> DataFrame:
    """Counts and sums by way of one row per member. Rows hold no more than that needs: they are moved and kept in state.

    With one kind of member there is no kind among the keys, and where every member counts there is no flag.
    """
    flags = {result: _member(s) for result, s in spec.distinct.items()}
    flagged = [result for result, s in spec.distinct.items() if not isinstance(s, str)]
    members = list(dict.fromkeys(column for column, _ in flags.values()))
    kinds = members + ([spec.name] if spec.name else [])
    if len(kinds) == 1:
        kind, tags, tagged = F.lit(0), ["member"], rows.withColumn("member", F.col(members[0]))
    else:
        entries = [F.struct(F.lit(i).alias("kind"), F.col(m).cast("string").alias("member"))
                   for i, m in enumerate(kinds)]
        kind, tags, tagged = F.col("kind"), ["kind", "member"], rows.select("*", F.inline(F.array(*entries)))

    lead, naming = kind == 0, kind == len(members)
    kept = [
        *[F.sum(F.when(lead, F.col(c))).alias(c) for c in spec.sums],
        *[F.max(flags[result][1]).alias(result) for result in flagged],
        *([F.min(F.when(naming, F.col("ts"))).alias("at")] if spec.name else []),
    ]
    reduced = tagged.groupBy(TIME, *spec.keys, *tags).agg(*(kept or [F.lit(1).alias("one")]))
    name = [F.when(naming, F.col("member")).alias("name"), naming.alias("naming")] if spec.name else []
    return reduced.groupBy(TIME, *spec.keys, *name).agg(
        *[F.sum(c).alias(c) for c in spec.sums],
        *[F.sum(F.when(kind == members.index(m), F.col(result) if result in flagged else F.lit(1)).otherwise(0))
          .cast("bigint").alias(result) for result, (m, _) in flags.items()],
        *([F.min("at").alias("at")] if spec.name else []),
    )


#: Steps of a sketch as a power of two; its error is about 1.04 / sqrt(2 ** SKETCH), here 1.6 %.
SKETCH = 12


def with_sketches(rows: DataFrame, spec: Summary, length: str = LENGTH) -> DataFrame:
    """The windows with a sketch (`<count>_sketch`) for each distinct count, of which longer windows can be made.

    One exchange: sketches are built where the rows are and merged. A missing member is a member of its own.
    """
    window = F.window("et", length)
    sketches = [F.hll_sketch_agg(F.when(flag > 0, F.coalesce(F.concat(F.lit("="), F.col(member).cast("string")), F.lit("-"))),
                                 SKETCH).alias(f"{result}_sketch")
                for result, (member, flag) in ((r, _member(s)) for r, s in spec.distinct.items())]
    grouped = rows.groupBy(window, *spec.keys).agg(*[F.sum(c).alias(c) for c in spec.sums], *sketches)
    return grouped.select(
        F.date_format("window.start", V.DATE_TIME).alias("stt"), F.date_format("window.end", V.DATE_TIME).alias("edt"),
        *spec.keys, *[f"{r}_sketch" for r in spec.distinct], *[F.col(c).cast(_sum_type(grouped, c)).alias(c) for c in spec.sums])


def rolled_up(windows: DataFrame, spec: Summary, length: str = "1 day") -> DataFrame:
    """Longer windows out of stored ones: sums are added, sketches merged and read. No fact is read again."""
    window = F.window(F.to_timestamp("stt", V.DATE_TIME), length)
    grouped = windows.groupBy(window, *spec.keys).agg(
        *[F.sum(c).alias(c) for c in spec.sums], *[F.hll_union_agg(f"{r}_sketch").alias(f"{r}_sketch") for r in spec.distinct])
    return grouped.select(
        F.date_format("window.start", V.DATE_TIME).alias("stt"), F.date_format("window.end", V.DATE_TIME).alias("edt"),
        *spec.keys, *[F.hll_sketch_estimate(f"{r}_sketch").alias(r) for r in spec.distinct], *spec.sums)


def _bounds(grouped: DataFrame, spec: Summary) -> DataFrame:
    return grouped.select(
        F.date_format("window.start", V.DATE_TIME).alias("stt"),
        F.date_format("window.end", V.DATE_TIME).alias("edt"),
        *spec.keys,
        *([spec.name] if spec.name else []),
        *spec.distinct,
        *[F.coalesce(F.col(c), F.lit(0)).cast(_sum_type(grouped, c)).alias(c) for c in spec.sums],
    )


def _sum_type(grouped: DataFrame, name: str) -> str:
    kind = grouped.schema[name].dataType.simpleString()
    return "decimal(18,2)" if kind.startswith("decimal") else kind


ORDER_DISTINCT = {"order_count": "order_id", "user_count": "user_id"}

# Summary tables by name.
SUMMARIES = {
    "dws_traffic_source_page_view_window":
        Summary(["source", "is_new"], ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]),
    "dws_traffic_keyword_window": Summary(["keyword"], ["keyword_count"]),
    "dws_user_traffic_home_detail_page_view_window": Summary([], ["home_count", "detail_count"]),
    "dws_user_user_login_window": Summary([], ["user_count", "back_count"]),
    "dws_user_user_register_window": Summary([], ["user_register_count"]),
    "dws_trade_cart_add_window": Summary(["course_id"], ["cart_count"], name="course_name"),
    "dws_trade_course_order_window":
        Summary(["course_id"], ["final_amount"], ORDER_DISTINCT, name="course_name"),
    "dws_trade_province_order_window": Summary(["province_id"], ["final_amount"], ORDER_DISTINCT),
    "dws_trade_source_order_window": Summary(["source_id"], ["final_amount"], ORDER_DISTINCT),
    "dws_trade_pay_suc_window": Summary(["province_id"], [], {"user_count": "user_id"}),
    "dws_interaction_course_review_window":
        Summary(["course_id"], ["score", "good_count"], {"user_count": "user_id"}),
    "dws_exam_paper_window":
        Summary(["paper_id"], ["exam_score", "duration_sec"], {"user_count": "user_id"}),
    "dws_exam_question_window":
        Summary(["question_id"], ["answer_count", "correct_answer_count"],
                {"answer_user_count": "user_id", "correct_answer_user_count": ("user_id", "correct_answer_count")}),
    "dws_play_video_chapter_window":
        Summary(["chapter_id", "chapter_name"], ["play_sec"], {"play_count": "sid", "user_count": "user_id"}),
}


def review_rates(summary: DataFrame) -> DataFrame:
    """Score and share of good reviews per user: whole numbers, and the exact ratios beside them."""
    users = F.col("user_count")
    return summary.select(
        "stt", "edt", "course_id",
        V.floor_div(F.col("score"), users).alias("avg_score"), "user_count",
        V.floor_div(F.col("good_count"), users).alias("good_rate"),
        (F.col("score") / users).alias("avg_score_exact"),
        (F.col("good_count") / users).alias("good_rate_exact"))


def exam_rates(summary: DataFrame) -> DataFrame:
    users = F.col("user_count")
    return summary.select(
        "stt", "edt", "paper_id",
        (F.col("exam_score") / users).alias("avg_score"), "user_count",
        V.floor_div(F.col("duration_sec"), users).alias("avg_dur_sec"),
        (F.col("duration_sec") / users).alias("avg_dur_sec_exact"))
