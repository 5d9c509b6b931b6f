"""Shaping of rows: the log split and the measures of each summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eduflow import schemas
from eduflow.functions import values as V
from eduflow.operators import filters

LOG_OBJECTS = ["start", "page", "err", "appVideo"]
LOG_LISTS = {"action": "actions", "display": "displays"}


def parse_log(lines: DataFrame) -> DataFrame:
    return filters.as_facts(lines, schemas.RAW_LOG)


def flat_log(log: DataFrame) -> DataFrame:
    """Parsed log with the device and new-visitor flag as columns of their own."""
    return log.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"), *log.columns)


def nested_log(log: DataFrame) -> DataFrame:
    """Put the (repaired) flag back into `common`."""
    flag = F.create_map(F.lit("is_new"), F.col("is_new"))
    common = F.when(F.col("is_new").isNull(), F.col("common")).otherwise(V.merge_maps(F.col("common"), flag))
    return log.withColumn("common", common).drop("mid", "is_new")


def split_log(log: DataFrame) -> DataFrame:
    """(kind, topic, data): one row per part of a log, with the common fields and the log's time.

    Common fields win over a part's own, and the log's `ts` wins over both. All kinds come from
    one pass over the log.
    """
    stamp = F.create_map(F.lit("ts"), F.col("ts").cast("string"))

    def full(part: Column) -> Column:
        return V.merge_maps(part, F.coalesce(F.col("common"), F.create_map().cast("map<string,string>")), stamp)

    def entry(kind: str, data: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(schemas.LOG_TOPICS[kind]).alias("topic"), data.alias("data"))

    def each(kind: str, many: str) -> Column:
        return F.transform(many, lambda part: entry(kind, full(part)))

    nothing = F.array().cast("array<struct<kind:string,topic:string,data:map<string,string>>>")
    parts = [F.when(F.col(kind).isNotNull(), F.array(entry(kind, full(F.col(kind))))).otherwise(nothing)
             for kind in LOG_OBJECTS]
    parts += [F.coalesce(each(kind, many), nothing) for kind, many in LOG_LISTS.items()]
    return log.select(F.explode(F.concat(*parts)).alias("part")).select("part.*")


def cart_measures(carts: DataFrame) -> DataFrame:
    return carts.select("course_id", "course_name", "ts", F.lit(1).cast("bigint").alias("cart_count"))


def register_measures(registers: DataFrame) -> DataFrame:
    return registers.select(V.date_time_millis(F.col("create_time")).alias("ts"),
                            F.lit(1).cast("bigint").alias("user_register_count"))


def payment_measures(details: DataFrame) -> DataFrame:
    return details.select("province_id", "user_id", "ts")


def review_measures(comments: DataFrame) -> DataFrame:
    """`create_time` may be epoch milliseconds or a date and time text."""
    stars = V.as_long(F.col("review_stars"))
    made = F.col("create_time")
    return comments.select(
        "course_id", "user_id",
        F.coalesce(V.as_long(made), V.date_time_millis(made)).alias("ts"),
        F.coalesce(stars, F.lit(0)).alias("score"),
        F.when(stars == 5, 1).otherwise(0).cast("bigint").alias("good_count"))


def exam_measures() -> dict[str, Column]:
    """Measures of an exam that a repeat corrects."""
    return {"exam_score": V.as_double(F.col("exam_score")), "duration_sec": V.as_long(F.col("duration_sec"))}


def order_measures() -> dict[str, Column]:
    return {"final_amount": V.as_money(F.col("final_amount"))}


def question_measures(questions: DataFrame) -> DataFrame:
    correct = F.coalesce(F.col("is_correct") == "1", F.lit(False))
    return questions.select(
        "question_id", "user_id", "ts",
        F.lit(1).cast("bigint").alias("answer_count"),
        correct.cast("bigint").alias("correct_answer_count"))


def video_measures(plays: DataFrame) -> DataFrame:
    return plays.select("video_id", "sid", "user_id", "ts",
                        F.coalesce("play_sec", F.lit(0)).cast("bigint").alias("play_sec"))
