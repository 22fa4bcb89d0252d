"""The given tables in the shapes the operators take: records, exports, span trees, documents.

Every input is derived from whole tables by Spark. The SQL twins of the record shapes stand beside
them, so that an oracle states results in terms of the tables and not of the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import cdc, quality
from tidemark.sources.landing import export_records, kafka_records

_JSON = {"ignoreNullFields": "false"}
REDELIVERY_MS = 60_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Tables up to this size may be shuffled to give every core a share of them.
SPREAD_BYTES = 256 << 20


def spread_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table that heavy work per row follows; a small one, stored in few splits, is spread first.

    Any larger table is read as it lies, without a shuffle.
    """
    df = table(spark, sf, name)
    stored = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(spark.sparkContext.defaultParallelism) if int(str(stored)) <= SPREAD_BYTES else df


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _text_id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _delivered(records: DataFrame, arrival: str, partition: Column, value: Column, redelivered: bool, broken: Column) -> DataFrame:
    """Kafka records as JSON lines; with `redelivered`, every one of them a second time.

    Of the `broken` records, those with an even number are cut off in the middle and the others stand
    twice in an array on one line.
    """
    copies = F.array(F.lit(0), F.lit(REDELIVERY_MS)) if redelivered else F.array(F.lit(0))
    record = F.struct(
        partition.cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        (F.col(arrival) + F.col("copy")).alias("timestamp"),
        value.alias("value"),
    )
    lines = records.withColumn("copy", F.explode(copies)).select("event_id", broken.alias("broken"), F.to_json(record, _JSON).alias("line"))
    cut = F.substring(F.col("line"), F.lit(1), (F.length("line") / 2).cast("int"))
    twice = F.concat(F.lit("["), "line", F.lit(","), "line", F.lit("]"))
    return lines.select(F.when(~F.col("broken"), F.col("line")).when(F.col("event_id") % 2 == 0, cut).otherwise(twice).alias("value"))


def _by_arrival_day(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("_batch_id", F.date_format("_ingested_at", "yyyy-MM-dd"))


# Product events. Clicks and purchases are sound; every other kind breaks one of the rules.
EVENT_SQL = """
SELECT event_id AS n, user_id AS u, ts,
       make_timestamp(epoch_us(ts) // 1000 * 1000 + (CAST(floor(value) AS BIGINT) % 4) * 86400000000) AS arrived,
       'e-' || event_id AS event_id,
       CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE 'u' || user_id END AS user_id,
       'T-' || user_id AS ticket_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'click'
            WHEN event_type IN ('purchase', 'signup') THEN 'feedback'
            WHEN value < 20 THEN 'feedback' WHEN value < 50 THEN 'click' ELSE 'error' END AS type,
       CASE WHEN event_type = 'purchase' AND value >= 20 THEN 'up'
            WHEN event_type = 'purchase' THEN 'down'
            WHEN event_type = 'view' THEN 'up'
            WHEN event_type = 'error' AND value >= 5 AND value < 20 THEN 'meh' END AS rating,
       props AS page,
       CASE WHEN event_type = 'click' OR event_type = 'purchase' THEN NULL
            WHEN event_type = 'error' AND value >= 100 AND event_id % 2 = 0 THEN 'record: not valid JSON'
            WHEN event_type = 'error' AND value >= 100 THEN 'record: not one record'
            WHEN event_type = 'signup' THEN 'record: Value error, feedback event needs rating up/down'
            WHEN event_type = 'view' THEN 'record: Value error, click event must not carry a rating'
            WHEN value < 5 THEN 'user_id: Input should be a valid string'
            WHEN value < 20 THEN 'rating: Input should be ''up'' or ''down'''
            WHEN value < 50 THEN 'event_time: Input should be a valid datetime'
            ELSE 'type: Input should be ''click'' or ''feedback''' END AS reason
FROM events
"""


def event_lines(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    kind, amount = F.col("event_type"), F.col("value")
    error = kind == "error"
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    value = F.struct(
        _text_id("e-", "event_id").alias("event_id"),
        F.when(error & (amount < 5), F.lit(None)).otherwise(_text_id("u", "user_id")).alias("user_id"),
        _text_id("T-", "user_id").alias("ticket_id"),
        F.when(kind.isin("click", "view"), "click")
        .when(kind.isin("purchase", "signup"), "feedback")
        .when(amount < 20, "feedback")
        .when(amount < 50, "click")
        .otherwise("error")
        .alias("type"),
        F.when((kind == "purchase") & (amount >= 20), "up")
        .when(kind == "purchase", "down")
        .when(kind == "view", "up")
        .when(error & (amount >= 5) & (amount < 20), "meh")
        .alias("rating"),
        F.col("props").alias("page"),
        # No time, or a number no time can have.
        F.when(error & (amount >= 20) & (amount < 30), "not a time")
        .when(error & (amount >= 30) & (amount < 40), "99999999999999999999")
        .when(error & (amount >= 40) & (amount < 50), "99999999999999999")
        .otherwise(time)
        .alias("event_time"),
    )
    late = (F.floor(amount) % 4) * 86_400_000
    records = spread_table(spark, sf, "events").withColumn("arrival", _millis(F.col("ts")) + late)
    return _delivered(records, "arrival", F.col("user_id") % 3, value, redelivered, error & (amount >= 100))


def bronze_events(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    return _by_arrival_day(kafka_records(event_lines(spark, sf, redelivered), "events", "", with_op=False))


def gated_events(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    return quality.gate_events(bronze_events(spark, sf, redelivered))


# Ticket changes: one ticket per user, the event number as sequence number, views as tombstones.
CHANGE_SQL = """
SELECT event_id AS lsn, user_id AS u,
       'T-' || user_id AS ticket_id,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       make_timestamp(epoch_us(ts) // 1000 * 1000) AS changed_at,
       strftime(make_timestamp(epoch_us(ts) // 1000 * 1000 + 2000000), '%Y-%m-%d') AS batch_id,
       CASE WHEN event_type <> 'error' THEN 'u' || user_id END AS user_id,
       CASE WHEN event_type <> 'error' THEN event_type || ' ' || props END AS subject,
       CASE WHEN event_type <> 'error' THEN 'mail <EMAIL> or call <PHONE>, order ' || event_id END AS body,
       CASE WHEN event_type = 'error' THEN NULL WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'medium' ELSE 'high' END AS priority,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'purchase' THEN 'closed' ELSE 'open' END AS status,
       CASE event_type WHEN 'click' THEN 'bug' WHEN 'purchase' THEN 'billing' END AS category,
       CASE WHEN event_type <> 'error' THEN ts END AS created_at
FROM events WHERE event_type <> 'view'
"""


def change_lines(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    kind, amount = F.col("event_type"), F.col("value")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ticket = _text_id("T-", "user_id").alias("ticket_id")
    body = F.concat(
        F.lit("mail u"), F.col("user_id"), F.lit("@example.com or call 0912 345 678, order "), F.col("event_id")
    )
    after = F.struct(
        ticket,
        _text_id("u", "user_id").alias("user_id"),
        F.concat(kind, F.lit(" "), F.col("props")).alias("subject"),
        body.alias("body"),
        F.when(amount < 10, "low").when(amount < 50, "medium").otherwise("high").alias("priority"),
        F.when(kind == "purchase", "closed").otherwise("open").alias("status"),
        F.when(kind == "click", "bug").when(kind == "purchase", "billing").alias("category"),
        micros.alias("created_at"),
        micros.alias("updated_at"),
    )
    change = F.struct(
        F.when(kind != "signup", F.struct(ticket)).alias("before"),
        F.when(kind != "error", after).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), _millis(F.col("ts")).alias("ts_ms")).alias("source"),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
    )
    records = spread_table(spark, sf, "events").withColumn("arrival", _millis(F.col("ts")) + 2000)
    # Of the tombstones some cannot be read, which is something else.
    broken = (kind == "view") & (amount >= 100)
    return _delivered(records, "arrival", F.lit(0), F.when(kind != "view", change), redelivered, broken)


def bronze_tickets(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    return _by_arrival_day(kafka_records(change_lines(spark, sf, redelivered), "tickets", "", with_op=True))


def ticket_changes(spark: SparkSession, sf: str, redelivered: bool = True) -> DataFrame:
    return cdc.decode_changes(bronze_tickets(spark, sf, redelivered))


# Exports: every turn of a conversation is a new export of its ticket, its lines the turns.
EXPORT_SQL = """
SELECT 'C-' || conv_id AS ticket_id, conv_id, turn,
       TIMESTAMP '2024-01-01' + turn * INTERVAL 1 HOUR AS exported_at,
       len(string_split(text, chr(10))) AS n_turns,
       array_to_string(list_transform(string_split(text, chr(10)), lambda t: role || ': ' || t), chr(10)) AS text
FROM conversations
"""


def export_objects(spark: SparkSession, sf: str, prefix: str = "C-") -> DataFrame:
    turns = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.col("role").alias("role"), line.alias("text"))
    )
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 3600)
    export = F.struct(
        _text_id(prefix, "conv_id").alias("ticket_id"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("exported_at"),
        turns.alias("turns"),
    )
    return spread_table(spark, sf, "conversations").select(F.to_json(export).alias("value"))


def bronze_exports(spark: SparkSession, sf: str) -> DataFrame:
    records = export_objects(spark, sf).select(F.parse_json("value").alias("record"))
    return _by_arrival_day(export_records(records, "transcripts", ""))


# Span trees: a document is a trace, its lines the child spans, their sentences the grandchildren.
def document_trees(spark: SparkSession, sf: str) -> DataFrame:
    def attributes(**values: Column) -> Column:
        # Attribute names hold dots; '__' stands for one.
        return F.struct(*[v.alias(k.replace("__", ".")) for k, v in values.items()])

    def span(span_id: Column, name: str, **more: Column) -> Column:
        return F.struct(span_id.alias("span_id"), F.lit(name).alias("name"), *[v.alias(k) for k, v in more.items()])

    doc = _text_id("d", "doc_id")

    def sentence(line_id: Column, text: Column, n: Column) -> Column:
        return span(
            F.concat(line_id, F.lit("."), n.cast("string")), "sentence", parent_id=line_id,
            attributes=attributes(gen_ai__usage__output_tokens=F.length(text)),
        )

    def line(text: Column, n: Column) -> Column:
        line_id = F.concat(doc, F.lit("."), n.cast("string"))
        return span(
            line_id, "line", parent_id=doc, status=F.when(text == "", "error").otherwise("ok"),
            attributes=attributes(gen_ai__usage__input_tokens=F.length(text)),
            children=F.transform(F.split(text, "[.] "), lambda s, m: sentence(line_id, s, m)),
        )

    root = span(
        doc, "document", duration_ms=F.col("n_chars"), status=F.when(F.col("lang") == "en", "ok").otherwise("error"),
        attributes=attributes(gen_ai__request__model=F.col("source"), input=F.col("text"), output=F.col("lang")),
        children=F.transform(F.split("text", "\n"), line),
    )
    docs = spread_table(spark, sf, "documents")
    return docs.select(
        F.struct(F.lit("").alias("file"), F.col("doc_id").alias("pos")).alias("trace_ord"),
        F.parse_json(F.to_json(root)).alias("root"),
    )


# Turns: a document is a prompt, good answers are those a label calls good, non-English ones held out.
TURN_SQL = """
SELECT d.doc_id, 'd' || d.doc_id AS trace_id, text AS user_input,
       lang || ' ' || d.doc_id AS agent_output,
       CASE WHEN quality = 1 THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN lang <> 'en' THEN 'eval' ELSE 'train' END AS split,
       trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS prompt
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


def answer_turns(spark: SparkSession, sf: str) -> DataFrame:
    labelled = spread_table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    root = F.struct(
        _text_id("d", "doc_id").alias("span_id"),
        F.lit("invoke_agent").alias("name"),
        F.when(F.col("quality") == 1, "ok").otherwise("error").alias("status"),
        F.struct(
            F.col("text").alias("input"),
            F.concat("lang", F.lit(" "), F.col("doc_id").cast("string")).alias("output"),
            F.when(F.col("lang") != "en", "eval").otherwise("train").alias("split"),
        ).alias("attributes"),
    )
    return labelled.select(
        F.struct(F.lit("").alias("file"), F.col("doc_id").alias("pos")).alias("trace_ord"),
        F.parse_json(F.to_json(root)).alias("root"),
    )


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")


# Product names of the part table.
PART_NOUNS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """(`doc`, `text`): every part, nation and customer described in sentences."""
    part = table(spark, sf, "part")
    size, noun = F.col("p_size").cast("string"), F.col("p_name")
    terms = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Each "), noun, F.lit(" is on final sale.")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("The "), noun, F.lit(" carries a "), size, F.lit("-day warranty.")))
        .otherwise(F.concat(F.lit("You may return a "), noun, F.lit(" within "), size, F.lit(" days! Thanks.")))
    )
    head = F.lit("# Notes. Widgets carry a 1-day warranty.\n\n")
    parts = part.select(_text_id("part-", "p_partkey").alias("doc"), F.concat(head, terms).alias("text"))
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    region = F.replace("r_name", F.lit(" "), F.lit("-"))
    nations = nation.select(
        _text_id("nation-", "n_nationkey").alias("doc"),
        F.concat(
            "n_name", F.lit(" belong to the "), region, F.lit(" category.\n"),
            "n_name", F.lit(" ship from the Port of "), "r_name", F.lit("."),
        ).alias("text"),
    )
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    customers = customer.select(
        _text_id("customer-", "c_custkey").alias("doc"),
        F.concat(
            F.lit("The "), "c_name", F.lit(" and "), "c_name", F.lit("-staff, the "), "c_name",
            F.lit("-family belong to the "), "n_name", F.lit(" category."),
        ).alias("text"),
    )
    return parts.unionByName(nations).unionByName(customers)


def place_edges(spark: SparkSession, sf: str) -> DataFrame:
    """world -> regions -> nations -> customers -> orders as an edge table."""
    def edges(df: DataFrame, subject: Column, relation: str, obj: Column, rank: int, key: str) -> DataFrame:
        order = F.struct(F.lit(rank).alias("rank"), F.col(key).cast("bigint").alias("key"))
        return df.select(subject.alias("subject"), F.lit(relation).alias("relation"), obj.alias("object"), order.alias("ord"))

    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    return (
        edges(region, F.lit("world"), "HAS_REGION", _text_id("r", "r_regionkey"), 0, "r_regionkey")
        .unionByName(edges(nation, _text_id("r", "n_regionkey"), "HAS_NATION", _text_id("n", "n_nationkey"), 1, "n_nationkey"))
        .unionByName(edges(customer, _text_id("n", "c_nationkey"), "HAS_CUSTOMER", _text_id("c", "c_custkey"), 2, "c_custkey"))
        .unionByName(edges(orders, _text_id("c", "o_custkey"), "PLACED", _text_id("o", "o_orderkey"), 3, "o_orderkey"))
    )
