"""The fourteen summaries: facts in, one row per window and key out.

`measure_*` shapes facts to measured rows with `ts` in milliseconds, `finish_*` adds rates and
dimension fields to a windowed summary. Batch plans chain the two around `summarise`; the streaming
jobs put a keyed-state operator and a watermark in between and share everything else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from eduflow.operators import filters, joins, projections, state, windows
from eduflow.operators.joins import Dims

ORDER_ARRIVAL = ["ts", "seq"]


def _millis(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", F.col("ts") * 1000)


def ordered(facts: DataFrame) -> DataFrame:
    """Facts whose rows of one second can be told apart: `seq` is their place in the source."""
    if "seq" not in facts.columns:
        raise ValueError("corrections need `seq`, the place of each fact in its source")
    return facts


# measured rows

def page_views(pages: DataFrame) -> DataFrame:
    return state.daily_visitors(pages, windows.DEVICE_ORDER)


def keywords(pages: DataFrame) -> DataFrame:
    return filters.keyword_views(pages).select(
        F.col("item").alias("keyword"), "ts", F.lit(1).cast("bigint").alias("keyword_count"))


def registers(facts: DataFrame) -> DataFrame:
    return projections.register_measures(facts)


def carts(facts: DataFrame) -> DataFrame:
    return _millis(projections.cart_measures(facts))


def corrected_orders(facts: DataFrame) -> DataFrame:
    kept = ordered(facts).select("id", "order_id", "user_id", "course_id", "course_name", "province_id",
                                  "sc", "final_amount", "ts", "seq")
    return state.correct_repeats(kept, "id", ORDER_ARRIVAL, projections.order_measures())


def course_orders(facts: DataFrame) -> DataFrame:
    return _millis(corrected_orders(facts))


def source_orders(facts: DataFrame) -> DataFrame:
    # the filter comes first: a row without a source takes no part in correction
    return _millis(corrected_orders(filters.sourced_orders(facts))).withColumnRenamed("sc", "source_id")


def payments(facts: DataFrame) -> DataFrame:
    return _millis(projections.payment_measures(facts))


def exam_papers(facts: DataFrame) -> DataFrame:
    kept = ordered(facts).select("exam_id", "paper_id", "user_id", "exam_score", "duration_sec", "ts", "seq")
    return _millis(state.correct_repeats(kept, "exam_id", ORDER_ARRIVAL, projections.exam_measures()))


def exam_questions(facts: DataFrame) -> DataFrame:
    return _millis(projections.question_measures(facts))


def video_plays(plays: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_chapter(projections.video_measures(plays), dims)


# finished rows

def _select(names: str) -> Callable[[DataFrame, Dims], DataFrame]:
    return lambda summary, dims: summary.select(*names.split())


def _finish_page_views(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_source(summary, dims).select(
        "stt", "edt", "source", "source_name", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum")


COURSE_PATH = "course_id course_name subject_id subject_name category_id category_name".split()


def _finish_carts(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_course_path(summary, dims).select("stt", "edt", *COURSE_PATH, "cart_count")


def _finish_course_orders(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_course_path(summary, dims).select(
        "stt", "edt", *COURSE_PATH, "order_count", "user_count", "final_amount")


def _finish_province_orders(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_province(summary, dims).select(
        "stt", "edt", "province_id", "province_name", "order_count", "user_count", "final_amount")


def _finish_source_orders(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_source(summary, dims, "source_id").select(
        "stt", "edt", "source_id", "source_name", "order_count", "user_count", "final_amount")


def _finish_payments(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_province(summary, dims).select("stt", "edt", "province_id", "province_name", "user_count")


def _finish_reviews(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_course_name(windows.review_rates(summary), dims).select(
        "stt", "edt", "course_id", "course_name", "avg_score", "user_count", "good_rate",
        "avg_score_exact", "good_rate_exact")


def _finish_papers(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_paper_path(windows.exam_rates(summary), dims).select(
        "stt", "edt", "paper_id", "paper_name", *COURSE_PATH, "avg_score", "user_count", "avg_dur_sec",
        "avg_dur_sec_exact")


def _finish_questions(summary: DataFrame, dims: Dims) -> DataFrame:
    return joins.add_question(summary, dims).select(
        "stt", "edt", "question_id", "question_name", "answer_count", "correct_answer_count",
        "answer_user_count", "correct_answer_user_count")


@dataclass(frozen=True)
class Job:
    """One summary job: its input topic, how rows are measured and how a summary is finished."""

    topic: str
    measure: Callable[..., DataFrame]
    finish: Callable[[DataFrame, Dims], DataFrame]
    key: str | None = None      # rows without this key cannot be grouped; they are dropped and counted
    needs_dims: bool = False


PAGE, ORDER, EXAM = "dwd_traffic_page", "dwd_trade_order_detail", "dwd_exam_exam_question"

JOBS = {
    "dws_traffic_source_page_view_window": Job(PAGE, page_views, _finish_page_views),
    "dws_traffic_keyword_window": Job(PAGE, keywords, _select("stt edt keyword keyword_count")),
    "dws_user_traffic_home_detail_page_view_window":
        Job(PAGE, filters.home_and_detail_views, _select("stt edt home_count detail_count")),
    "dws_user_user_login_window": Job(PAGE, state.daily_logins, _select("stt edt user_count back_count")),
    "dws_user_user_register_window":
        Job("dwd_user_register", registers, _select("stt edt user_register_count")),
    "dws_trade_cart_add_window": Job("dwd_trade_cart_add", carts, _finish_carts, "course_id"),
    "dws_trade_course_order_window": Job(ORDER, course_orders, _finish_course_orders, "course_id"),
    "dws_trade_province_order_window": Job(ORDER, course_orders, _finish_province_orders, "province_id"),
    "dws_trade_source_order_window": Job(ORDER, source_orders, _finish_source_orders, "source_id"),
    "dws_trade_pay_suc_window": Job("dwd_trade_pay_suc_detail", payments, _finish_payments, "province_id"),
    "dws_interaction_course_review_window":
        Job("dwd_interaction_comment", projections.review_measures, _finish_reviews, "course_id"),
    "dws_exam_paper_window": Job(EXAM, exam_papers, _finish_papers, "paper_id"),
    "dws_exam_question_window": Job(EXAM, exam_questions, _finish_questions, "question_id"),
    "dws_play_video_chapter_window":
        Job("dwd_traffic_appVideo", video_plays,
            _select("stt edt chapter_id chapter_name play_count play_sec user_count"), "chapter_id", True),
}


def measured(table: str, facts: DataFrame, dims: Dims | None = None) -> DataFrame:
    job = JOBS[table]
    rows = job.measure(facts, dims) if job.needs_dims else job.measure(facts)
    return filters.event_timed(keyed(table, rows))


def keyed(table: str, rows: DataFrame) -> DataFrame:
    key = JOBS[table].key
    return filters.with_key(rows, key, f"{table}_lost") if key else rows


def windowed(table: str, facts: DataFrame, dims: Dims | None = None, length: str = windows.LENGTH) -> DataFrame:
    """The summary without dimension fields."""
    return windows.summarise(measured(table, facts, dims), windows.SUMMARIES[table], length)


def summary(table: str, facts: DataFrame, dims: Dims, length: str = windows.LENGTH) -> DataFrame:
    """The summary as it is stored, from a finite table of facts."""
    return JOBS[table].finish(windowed(table, facts, dims, length), dims)
