"""The given tables, seen as the inputs of the warehouse.

Each function reads whole tables. Event times are the tables' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eduflow.functions import values as V

DATABASE = "edu"
FAR_YEAR = 2200


class Inputs:
    def __init__(self, spark: SparkSession, folder: str, live: tuple[str, ...] = (), closing: str | None = None,
                 half: int | None = None):
        """`live` tables are read as streams; the rows in the folder `closing` come after them, file by file.

        `half` 0 and 1 are the earlier and the later events, for queries that run on both, one after the other.
        """
        self.half = half
        self.spark = spark
        self.folder = folder
        self.live = live
        self.closing = closing

    def table(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in self.live:
            stream = self.spark.readStream.schema(table.schema)
            rows = stream.option("recursiveFileLookup", "false").parquet(f"{self.folder}/{name}.parquet*")
            if not self.closing:
                return rows
            return rows.union(stream.option("maxFilesPerTrigger", 1).parquet(f"{self.closing}/{name}"))
        return table

    def close(self, name: str, key: Column | None = None) -> None:
        """Write rows of a table's kind that lie far ahead: after them no window of the table is open.

        The first file is empty, so that it comes with the table itself. `key` replaces the order key of line items.
        """
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name == "events":
            base = table.groupBy("event_type").agg(F.min_by(F.struct(*table.columns), "event_id").alias("r")).select("r.*")
            time = "ts"
        elif name == "orders":
            base, time = table.orderBy("o_orderkey").limit(1), "o_orderdate"
        else:
            bought = self.spark.read.parquet(f"{self.folder}/events.parquet").where("event_type = 'purchase'")
            sold = table.join(bought, F.col("l_orderkey") == F.col("event_id"), "left_semi")
            base = sold.orderBy("l_orderkey", "l_linenumber").limit(1)
            time = "l_shipdate"
        for number in range(5):
            far = F.lit(f"{FAR_YEAR + number}-01-01").cast(table.schema[time].dataType)
            rows = base.withColumn(time, far).limit(100 if number else 0)
            if name == "lineitem":
                line = F.lit(100 + number).cast(table.schema["l_linenumber"].dataType)
                rows = rows.withColumn("l_linenumber", line)
                if key is not None:
                    rows = rows.withColumn("l_orderkey", (key - number).cast(table.schema["l_orderkey"].dataType))
            rows.select(*table.columns).coalesce(1).write.mode("append").parquet(f"{self.closing}/{name}")

    # events

    def events(self) -> DataFrame:
        """Events with `k`, the number in their properties, and `ms`, their epoch milliseconds."""
        rows = self.table("events")
        if self.half is not None:
            middle = rows.agg(F.floor(F.max("event_id") / 2)).first()[0] or 0
            rows = rows.where(F.col("event_id") > middle if self.half else F.col("event_id") <= middle)
        return rows.select(
            "event_id", "user_id", "event_type", "value",
            F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))

    def page_log(self) -> DataFrame:
        kind, k = F.col("event_type"), F.col("k")
        page = (F.when(kind == "view", "home").when(kind == "click", "course_detail")
                .when(kind == "purchase", "order").when(kind == "signup", "search").otherwise("other"))
        item_type = F.when(kind == "signup", "keyword").when(kind == "purchase", "order_id")
        item = F.when(kind == "purchase", text("event_id")).otherwise(k.cast("string"))
        return self.events().select(
            F.concat_ws("-", "user_id", (k % 10).cast("string")).alias("mid"),
            F.when(k % 7 != 0, text("user_id")).alias("uid"),
            (k % 30).cast("string").alias("sc"),
            (k % 2).cast("string").alias("is_new"),
            page.alias("page_id"),
            F.when(k % 5 != 0, F.lit("home")).alias("last_page_id"),
            item.alias("item"), item_type.alias("item_type"),
            F.floor(F.col("value") * 1000).alias("during_time"), F.col("ms").alias("ts"))

    def raw_log_lines(self) -> DataFrame:
        """Raw logs as JSON text; parts by kind of event."""
        kind, k = F.col("event_type"), F.col("k")
        common = F.struct(
            F.concat_ws("-", "user_id", (k % 10).cast("string")).alias("mid"),
            (k % 2).cast("string").alias("is_new"), (k % 30).cast("string").alias("sc"),
            text("user_id").alias("uid"))
        page = F.struct(kind.alias("page_id"), F.lit("from-page").alias("sc"), text("event_id").alias("item"))
        only = F.struct(text("event_id").alias("item"))

        def many(n: Column) -> Column:
            return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(
                i.cast("string").alias("item"), F.lit("1").alias("ts"))))

        line = F.struct(
            common.alias("common"), F.col("ms").alias("ts"),
            F.when(kind == "signup", only).alias("start"),
            F.when(kind.isin("view", "click", "purchase"), page).alias("page"),
            F.when(kind == "error", only).alias("err"),
            F.when(kind == "view", only).alias("appVideo"),
            many(k % 3).alias("actions"), many(k % 4).alias("displays"))
        return self.events().select(F.to_json(line).alias("value"))

    def event_changes(self) -> DataFrame:
        """Change rows made of events: 20 tables, all kinds of change, another database among them."""
        kind, k = F.col("event_type"), F.col("k")
        return self.events().select(
            F.when(kind == "error", "other").otherwise(DATABASE).alias("database"),
            F.when(k != 13, F.concat(F.lit("t"), (k % 20).cast("string"))).alias("table"),
            (F.when(kind == "view", "bootstrap-insert").when(kind == "click", "update")
             .when(kind == "purchase", "delete").otherwise("insert")).alias("type"),
            F.when(k == 17, F.create_map().cast("map<string,string>")).otherwise(F.create_map(
                F.lit("id"), text("event_id"), F.lit("user_id"), text("user_id"),
                F.lit("note"), F.lit("bootstrap-note"), F.lit("k"), k.cast("string"))).alias("data"),
            F.floor(F.col("ms") / 1000).alias("ts"), "event_id")

    def event_change_lines(self) -> DataFrame:
        """The same rows as JSON text, some of it cut off."""
        line = F.to_json(F.struct("database", "table", "type", "data", "ts"))
        return self.event_changes().select(
            F.when(F.col("event_id") % 11 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))

    def config_lines(self) -> DataFrame:
        """Config changes as JSON envelopes: one per event, for 20 tables and two kinds of sink."""
        kind, k = F.col("event_type"), F.col("k")
        image = F.struct(
            F.concat(F.lit("t"), (k % 20).cast("string")).alias("source_table"),
            F.when(k % 2 == 0, "insert").otherwise("update").alias("source_type"),
            F.concat(F.lit("sink_"), (k % 20).cast("string")).alias("sink_table"),
            F.when(F.col("event_id") % 2 == 0, "dim").otherwise("dwd").alias("sink_type"),
            F.when(F.col("user_id") % 2 == 0, "id,k").otherwise("id,user_id").alias("sink_columns"),
            F.lit("id").alias("sink_pk"))
        op = (F.when(kind == "view", "c").when(kind == "click", "u").when(kind == "error", "d")
              .when(kind == "signup", "r").otherwise("u"))
        line = F.struct(
            op.alias("op"), F.when(op.isin("d", "u"), image).alias("before"),
            F.when(op != "d", image).alias("after"), F.col("event_id").alias("ts_ms"))
        return self.events().select(F.to_json(line).alias("value"))

    def registers(self) -> DataFrame:
        return self.events().where("event_type = 'signup'").select(V.date_time_text(F.col("ms")).alias("create_time"))

    def comments(self) -> DataFrame:
        """Views as reviews; the time is a number or a text."""
        made = F.when(F.col("k") % 2 == 0, F.col("ms").cast("string")).otherwise(V.date_time_text(F.col("ms")))
        return self.events().where("event_type = 'view'").select(
            F.col("k").cast("string").alias("course_id"), text("user_id").alias("user_id"),
            (1 + F.col("user_id") % 5).cast("string").alias("review_stars"), made.alias("create_time"))

    def video_plays(self) -> DataFrame:
        k = F.col("k")
        return self.events().select(
            (F.col("user_id") * 20 + k % 20).cast("string").alias("video_id"),
            k.cast("string").alias("sid"),
            F.when(k % 7 != 0, text("user_id")).alias("user_id"),
            F.when(k % 9 != 0, F.floor("value")).alias("play_sec"), F.col("ms").alias("ts"))

    # orders and line items, as change rows

    def _change(self, rows: DataFrame, table: str, kind: Column, ts: Column, arrival: Column | None = None,
                **data: Column) -> DataFrame:
        entries = [part for name, value in data.items() for part in (F.lit(name), value.cast("string"))]
        return rows.select(
            F.lit(DATABASE).alias("database"), F.lit(table).alias("table"), kind.alias("type"),
            F.create_map(*entries).alias("data"), ts.alias("ts"), *([] if arrival is None else [arrival.alias("seq")]))

    def cart_changes(self) -> DataFrame:
        k = F.col("k")
        return self._change(
            self.events(), "cart_info", F.when(F.col("event_type") == "click", "insert").otherwise("update"),
            F.floor(F.col("ms") / 1000), id=F.col("event_id"), user_id=F.col("user_id"), course_id=k,
            course_name=F.concat(F.lit("course "), k.cast("string")))

    def detail_changes(self, numbered: bool = False) -> DataFrame:
        """Line items as new order details; `numbered` by arrival."""
        item = self.table("lineitem")
        return self._change(
            item, "order_detail", F.lit("insert"), seconds("l_shipdate"), arrival() if numbered else None,
            id=F.concat_ws("-", "l_orderkey", "l_linenumber"), course_id=F.col("l_suppkey"),
            course_name=F.concat(F.lit("course "), text("l_suppkey")), order_id=F.col("l_orderkey"),
            user_id=F.col("l_partkey"), final_amount=money("l_extendedprice"),
            create_time=V.date_time_text(seconds("l_shipdate") * 1000))

    def info_changes(self) -> DataFrame:
        orders = self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return self._change(orders, "order_info", F.lit("insert"), seconds("o_orderdate"),
                            id=F.col("o_orderkey"), province_id=F.col("c_nationkey"))

    def payment_changes(self) -> DataFrame:
        """Orders as payments: finished ones are new, open ones called back, others plain updates."""
        status = F.col("o_orderstatus")
        return self._change(
            self.table("orders"), "payment_info", F.when(status == "F", "insert").otherwise("update"),
            seconds("o_orderdate"), id=F.concat(F.lit("p"), text("o_orderkey")), order_id=F.col("o_orderkey"),
            create_time=V.date_time_text(seconds("o_orderdate") * 1000), payment_type=F.col("o_orderpriority"),
            callback_time=F.when(status == "O", F.lit("done")))

    def question_changes(self) -> DataFrame:
        return self._change(
            self.table("lineitem"), "test_exam_question", F.lit("insert"), seconds("l_shipdate"),
            id=F.concat_ws("-", "l_orderkey", "l_linenumber"), exam_id=F.col("l_orderkey"),
            paper_id=F.col("l_partkey"), question_id=F.col("l_partkey"), user_id=F.col("l_suppkey"),
            is_correct=F.when(F.col("l_returnflag") == "A", "1").otherwise("0"),
            score=F.col("l_quantity").cast("int"), create_time=V.date_time_text(seconds("l_shipdate") * 1000))

    def exam_changes(self) -> DataFrame:
        return self._change(
            self.table("orders"), "test_exam", F.lit("insert"), seconds("o_orderdate"),
            id=F.col("o_orderkey"), score=F.col("o_custkey") % 100, duration_sec=F.col("o_custkey"),
            create_time=V.date_time_text(seconds("o_orderdate") * 1000))

    # detail facts, as the layer above reads them

    def order_details(self) -> DataFrame:
        """Line items with the province and source of their order, numbered by arrival."""
        item = self.table("lineitem")
        infos = (self.table("orders").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
                 .select("o_orderkey", "o_custkey", "c_nationkey"))
        sources = self.events().where("event_type = 'purchase'").select(
            F.col("event_id"), (F.col("k") % 30).cast("string").alias("sc"))
        return (
            item.join(infos, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(sources, F.col("l_orderkey") == F.col("event_id"), "left")
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
                text("l_suppkey").alias("course_id"),
                F.concat(F.lit("course "), text("l_suppkey")).alias("course_name"),
                text("l_orderkey").alias("order_id"), text("o_custkey").alias("user_id"),
                money("l_extendedprice").cast("string").alias("final_amount"),
                text("c_nationkey").alias("province_id"),
                V.date_time_text(seconds("l_shipdate") * 1000).alias("create_time"), "sc",
                seconds("l_shipdate").alias("ts"), arrival().alias("seq"))
        )

    def payment_details(self) -> DataFrame:
        return self.order_details().select("province_id", "user_id", "ts")

    def exam_questions(self) -> DataFrame:
        """Line items as answers; score and duration differ between the rows of an exam."""
        return self.table("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), text("l_orderkey").alias("exam_id"),
            text("l_partkey").alias("paper_id"), text("l_partkey").alias("question_id"),
            text("l_suppkey").alias("user_id"),
            F.when(F.col("l_returnflag") == "A", "1").otherwise("0").alias("is_correct"),
            text("l_quantity").alias("exam_score"), (F.col("l_linenumber") * 60).cast("string").alias("duration_sec"),
            seconds("l_shipdate").alias("ts"), arrival().alias("seq"))

    # dimensions

    def dim(self, name: str) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        supplier, part = self.table("supplier"), self.table("part")
        if name in ("dim_base_source", "dim_base_province"):
            column = "source_site" if name == "dim_base_source" else "name"
            return nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias(column))
        if name == "dim_course_info":
            return supplier.select(text("s_suppkey").alias("id"), F.col("s_name").alias("course_name"),
                                   text("s_nationkey").alias("subject_id"))
        if name == "dim_base_subject_info":
            return nation.select(text("n_nationkey").alias("id"), F.col("n_name").alias("subject_name"),
                                 text("n_regionkey").alias("category_id"))
        if name == "dim_base_category_info":
            return region.select(text("r_regionkey").alias("id"), F.col("r_name").alias("category_name"))
        if name == "dim_test_paper":
            return part.select(text("p_partkey").alias("id"), F.col("p_name").alias("paper_title"),
                               text("p_partkey").alias("course_id"))
        if name == "dim_test_question_info":
            return part.select(text("p_partkey").alias("id"), F.col("p_type").alias("question_txt"))
        if name == "dim_video_info":
            return part.select(text("p_partkey").alias("id"), F.col("p_brand").alias("chapter_id"))
        if name == "dim_chapter_info":
            return part.groupBy(F.col("p_brand").alias("id")).agg(
                F.concat(F.lit("Chapter "), F.first("p_brand")).alias("chapter_name"))
        raise KeyError(name)


def text(name: str) -> Column:
    return F.col(name).cast("string")


def seconds(name: str) -> Column:
    return F.unix_seconds(F.col(name).cast("timestamp"))


def money(name: str) -> Column:
    return F.col(name).cast(V.MONEY)


def arrival() -> Column:
    """A number that orders the line items of one id and day: part, then price, then supplier."""
    part, supplier = F.col("l_partkey").cast("decimal(18,0)"), F.col("l_suppkey").cast("decimal(18,0)")
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(18,0)")
    wide = F.lit("1000000000000").cast("decimal(13,0)")
    return ((part * wide + cents).cast("decimal(25,0)") * wide + supplier).cast("decimal(38,0)")
