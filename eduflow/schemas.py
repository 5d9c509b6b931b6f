"""Row shapes that pass between the layers."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
#: Order of arrival: wide enough for any transaction and any place in it.
SEQ = T.DecimalType(38, 0)


def _row(text: str = "", **typed: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in text.split()]
    fields += [T.StructField(name, kind) for name, kind in typed.items()]
    return T.StructType(fields)


RAW_LOG = _row(
    common=_TEXT_MAP, ts=T.LongType(),
    start=_TEXT_MAP, page=_TEXT_MAP, err=_TEXT_MAP, appVideo=_TEXT_MAP,
    actions=T.ArrayType(_TEXT_MAP), displays=T.ArrayType(_TEXT_MAP),
)
CHANGE_LOG = _row("database table type", data=_TEXT_MAP, old=_TEXT_MAP, ts=T.LongType(),
                  xid=T.LongType(), xoffset=T.LongType())

CONFIG = _row("source_table source_type sink_table sink_type sink_columns sink_pk sink_extend")
CONFIG_CHANGE = _row("op", before=CONFIG, after=CONFIG, ts_ms=T.LongType(), pos=T.LongType())

PAGE_LOG = _row("mid uid sc is_new page_id last_page_id item item_type",
                during_time=T.LongType(), ts=T.LongType())
CART_ADD = _row("id user_id course_id course_name", ts=T.LongType())
ORDER_DETAIL = _row("id course_id course_name order_id user_id final_amount province_id create_time sc",
                    ts=T.LongType(), seq=SEQ)
PAY_DETAIL = _row("id order_id create_time payment_type course_id course_name province_id user_id "
                  "order_detail_amount sc", ts=T.LongType())
EXAM_QUESTION = _row("id exam_id paper_id question_id user_id is_correct question_score exam_score "
                     "duration_sec create_time", ts=T.LongType(), seq=SEQ)
USER_REGISTER = _row("create_time")
COMMENT = _row("course_id user_id review_stars create_time")
VIDEO_PLAY = _row("video_id sid user_id", play_sec=T.LongType(), ts=T.LongType())

# Topic names, fixed values shared by producers and consumers of the layers.
RAW_LOG_TOPIC = "edu_ods_log"
CHANGE_LOG_TOPIC = "edu_ods_db"
LOG_TOPICS = {
    "start": "dwd_traffic_start",
    "page": "dwd_traffic_page",
    "err": "dwd_traffic_err",
    "appVideo": "dwd_traffic_appVideo",
    "action": "dwd_traffic_action",
    "display": "dwd_traffic_display",
}
FACT_TOPICS = {
    "dwd_trade_cart_add": CART_ADD,
    "dwd_trade_order_detail": ORDER_DETAIL,
    "dwd_trade_pay_suc_detail": PAY_DETAIL,
    "dwd_exam_exam_question": EXAM_QUESTION,
    "dwd_user_register": USER_REGISTER,
    "dwd_interaction_comment": COMMENT,
}
