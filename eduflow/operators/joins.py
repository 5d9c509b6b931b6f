"""Joins between facts, and look-ups of dimensions.

No join carries a broadcast hint. A dimension is broadcast when its size, estimated or measured at
run time, is under Spark's threshold; a larger one is joined by key, where adaptive execution cuts
hot keys into several tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from eduflow.streaming.fact_join import fact_join

Dims = Callable[[str], DataFrame]

ORDER_COLUMNS = ("id course_id course_name order_id user_id final_amount province_id create_time sc ts").split()


def _spread(rows: DataFrame, by: str, salt: int) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salt)).cast("int"))


def _repeat(rows: DataFrame, salt: int) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))


def _near(left: str, right: str, before: str, after: str) -> Column:
    return F.expr(f"{right} between {left} - interval {before} and {left} + interval {after}")


def _fact_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
               near: tuple[str, str] | None, salt: int, spread_by: str, lag: str | None = None) -> DataFrame:
    """Equi-join of two facts; `near` bounds their event times, which bounds a stream's state.

    With `salt` above 1 the left rows of one key go to that many tasks and the right rows to each
    of them; for streams, where no run-time splitting exists. `lag`: see `fact_join`.
    """
    if salt > 1:
        left = _spread(left, spread_by, salt)
        right = _repeat(right, salt).withColumnRenamed("salt", "right_salt")
    if left.isStreaming and right.isStreaming:
        keys = F.col(left_key).cast("string"), F.col(right_key).cast("string")
        if salt > 1:
            keys = F.concat(F.col("salt").cast("string"), F.lit(" "), keys[0]), F.concat(
                F.col("right_salt").cast("string"), F.lit(" "), keys[1])
        return fact_join(left, right, *keys, how, near, spread_by, lag)
    on = F.col(left_key) == F.col(right_key)
    if salt > 1:
        on = on & (F.col("salt") == F.col("right_salt"))
    if near:
        on = on & _near("l_et", "r_et", *near)
    joined = left.join(right, on, how)
    return joined.drop("salt", "right_salt") if salt > 1 else joined


def _timed(rows: DataFrame, name: str, near) -> DataFrame:
    return rows.withColumnRenamed("et", name) if near else rows


def orders_with_province(details: DataFrame, infos: DataFrame, near=None, salt: int = 1) -> DataFrame:
    """Order details with the province of their order."""
    right = _timed(infos, "r_et", near).withColumnRenamed("id", "info_id").drop("ts")
    joined = _fact_join(_timed(details, "l_et", near), right, "order_id", "info_id", "inner", near, salt, "id")
    return joined.drop("info_id", "r_et").withColumnRenamed("l_et", "et")


def orders_with_source(details: DataFrame, sources: DataFrame, near=None, salt: int = 1,
                       lag: str | None = None) -> DataFrame:
    """Add the source that led to the order; null when none is known. `lag`: how late a stream of details, joined before, comes."""
    right = _timed(sources, "r_et", near).drop("ts")
    joined = _fact_join(_timed(details, "l_et", near), right, "order_id", "item", "left", near, salt, "id", lag)
    return joined.drop("item", "r_et").withColumnRenamed("l_et", "et")


def order_detail_facts(details: DataFrame, infos: DataFrame, sources: DataFrame,
                       info_near=None, source_near=None, salt: int = 1) -> DataFrame:
    both = orders_with_source(orders_with_province(details, infos, info_near, salt), sources, source_near, salt,
                              info_near and info_near[1])
    return both.select(*ORDER_COLUMNS, *_place(both))


def order_detail_changes(details: DataFrame, infos: DataFrame, sources: DataFrame,
                         info_near=None, source_near=None, salt: int = 1) -> DataFrame:
    """Order details as they become known: a row without a source at once, and when a source comes, a row that takes
    the first one back (`gone`) and the corrected one. `version` orders the rows of an id.

    On streams all rows come out of one inner join, which holds nothing back: the order's own row, as a source that
    is null, is joined like the sources are. `source_near` lies within `info_near`.
    """
    placed = orders_with_province(details, infos, info_near, salt)
    when = ["et"] if info_near else []
    none = infos.select(F.col("id").alias("item"), F.lit(None).cast("string").alias("sc"),
                        F.lit(None).cast("bigint").alias("known"), *when)
    some = sources.select("item", "sc", F.col("ts").alias("known"), *when)
    right = _timed(none.union(some), "r_et", info_near)
    joined = _fact_join(_timed(placed, "l_et", info_near), right, "order_id", "item", "inner", info_near, salt, "id",
                        info_near and info_near[1])
    if source_near:
        joined = joined.where(F.col("known").isNull() | _near("l_et", "r_et", *source_near))

    def row(version: Column, gone: bool) -> Column:
        return F.struct(version.cast("bigint").alias("version"), F.lit(gone).alias("gone"))

    at = F.col("known") * 2
    rows = F.when(F.col("known").isNull(), F.array(row(F.lit(0), False))).otherwise(
        F.array(row(at + 1, True), row(at + 2, False)))
    out = joined.select("*", F.inline(rows))
    return out.select(*ORDER_COLUMNS, *_place(out), "version", "gone")


def _place(rows: DataFrame) -> list[str]:
    """Order of arrival, where rows carry it."""
    return ["seq"] if "seq" in rows.columns else []


def payment_facts(payments: DataFrame, details: DataFrame, near=None, salt: int = 1) -> DataFrame:
    """Each payment with every detail of its order."""
    # details repeat per order, so they are the side that is spread out
    left = _timed(details, "l_et", near).select(
        F.col("id").alias("detail_id"), F.col("order_id").alias("detail_order"),
        "course_id", "course_name", "province_id", "user_id",
        F.col("final_amount").alias("order_detail_amount"), "sc", *(["l_et"] if near else []))
    right = _timed(payments, "r_et", near)
    joined = _fact_join(left, right, "detail_order", "order_id", "inner", near, salt, "detail_id")
    return joined.select("id", "order_id", "create_time", "payment_type", "course_id", "course_name",
                         "province_id", "user_id", "order_detail_amount", "sc", "ts")


def exam_question_facts(questions: DataFrame, exams: DataFrame, near=None, salt: int = 1) -> DataFrame:
    """Each answered question with the score and duration of its exam."""
    right = _timed(exams, "r_et", near).select(
        F.col("id").alias("exam"), F.col("score").alias("exam_score"), "duration_sec",
        *(["r_et"] if near else []))
    left = _timed(questions, "l_et", near).withColumnRenamed("score", "question_score")
    joined = _fact_join(left, right, "exam_id", "exam", "inner", near, salt, "id")
    return joined.select("id", "exam_id", "paper_id", "question_id", "user_id", "is_correct",
                         "question_score", "exam_score", "duration_sec", "create_time", "ts", *_place(questions))


# dimensions

def look_up(rows: DataFrame, dim: DataFrame, key: str, **fields: str) -> DataFrame:
    """Left join by id; `fields` maps new columns to columns of the dimension. No match gives nulls."""
    chosen = dim.select(F.col("id").alias("dim_key"), *[F.col(source).alias(name) for name, source in fields.items()])
    return rows.drop(*fields).join(chosen, F.col(key) == F.col("dim_key"), "left").drop("dim_key")


def add_source(rows: DataFrame, dims: Dims, key: str = "source") -> DataFrame:
    return look_up(rows, dims("dim_base_source"), key, source_name="source_site")


def add_province(rows: DataFrame, dims: Dims) -> DataFrame:
    return look_up(rows, dims("dim_base_province"), "province_id", province_name="name")


def _add_subject_and_category(rows: DataFrame, dims: Dims) -> DataFrame:
    rows = look_up(rows, dims("dim_base_subject_info"), "subject_id",
                   subject_name="subject_name", category_id="category_id")
    return look_up(rows, dims("dim_base_category_info"), "category_id", category_name="category_name")


def add_course_path(rows: DataFrame, dims: Dims) -> DataFrame:
    """course -> subject -> category."""
    return _add_subject_and_category(
        look_up(rows, dims("dim_course_info"), "course_id", subject_id="subject_id"), dims)


def add_course_name(rows: DataFrame, dims: Dims) -> DataFrame:
    return look_up(rows, dims("dim_course_info"), "course_id", course_name="course_name")


def add_paper_path(rows: DataFrame, dims: Dims) -> DataFrame:
    """paper -> course -> subject -> category."""
    rows = look_up(rows, dims("dim_test_paper"), "paper_id", paper_name="paper_title", course_id="course_id")
    rows = look_up(rows, dims("dim_course_info"), "course_id", course_name="course_name", subject_id="subject_id")
    return _add_subject_and_category(rows, dims)


def add_question(rows: DataFrame, dims: Dims) -> DataFrame:
    return look_up(rows, dims("dim_test_question_info"), "question_id", question_name="question_txt")


def add_chapter(rows: DataFrame, dims: Dims) -> DataFrame:
    """video -> chapter."""
    rows = look_up(rows, dims("dim_video_info"), "video_id", chapter_id="chapter_id")
    return look_up(rows, dims("dim_chapter_info"), "chapter_id", chapter_name="chapter_name")
