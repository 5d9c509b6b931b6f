"""Detail facts from the change log and the page log, as batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eduflow import session
from eduflow.operators import filters, joins, projections, routing, state


def logs(raw: DataFrame) -> DataFrame:
    """Raw logs to (kind, topic, data), with the new-visitor flag repaired.

    The flag needs the log twice, so the parsed log is stored once: a line is parsed once.
    """
    flat = session.stored(projections.flat_log(raw))
    return projections.split_log(projections.nested_log(state.repair_new_flag(flat)))


def cart_adds(changes: DataFrame, database: str) -> DataFrame:
    return filters.cart_adds(changes, database)


def order_details(changes: DataFrame, pages: DataFrame, database: str) -> DataFrame:
    return joins.order_detail_facts(
        filters.order_details(changes, database), filters.order_infos(changes, database),
        filters.order_sources(pages))


def payments(changes: DataFrame, details: DataFrame, database: str) -> DataFrame:
    return joins.payment_facts(filters.payments(changes, database), details)


def exam_questions(changes: DataFrame, database: str) -> DataFrame:
    return joins.exam_question_facts(filters.exam_questions(changes, database), filters.exams(changes, database))


def routed(changes: DataFrame, config: DataFrame, database: str) -> DataFrame:
    return routing.route_facts(filters.clean_changes(changes, database), config)


def dim_rows(changes: DataFrame, config: DataFrame, database: str) -> DataFrame:
    return routing.route_dims(filters.clean_changes(changes, database), config)
