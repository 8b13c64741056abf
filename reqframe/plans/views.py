"""The engine's inputs derived from the test tables. Every view covers its whole table.

Lines come unparsed, as from files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import computed_once
from reqframe.operators.build import CHAT_URL, METHOD, chat_line, numbered
from reqframe.session import configure
from reqframe.sources.lines import is_dir
from reqframe.sources.literal import literal_rows
from reqframe.sources.tables import indexed_table, spread


class Tables:
    """Lazy access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


    def stream(self, name: str, schema) -> DataFrame:
        """A table as a file stream. A stream source must be a folder, whether or not the table is."""
        reader = self.spark.readStream.schema(schema)
        path = f"{self.folder}/{name}.parquet"
        if is_dir(self.spark, path):
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)


def documents(t: Tables) -> DataFrame:
    return spread(t.documents, "doc_id")


def doc_id() -> Column:
    return numbered("doc-", 6, "doc_id")


def model() -> Column:
    return F.concat(F.lit("m-"), F.col("lang"))


def request_raw() -> Column:
    return chat_line(doc_id(), F.col("text"), model(), max_tokens=F.col("n_chars"))


def _as_lines(df: DataFrame, line: Column, file: Column, raw: Column) -> DataFrame:
    """Lines of a table with a dense key; the key stands for the line's place in its file."""
    place = line.cast("bigint")
    return computed_once(df, "raw", raw).select(
        file.alias("file"), (place + 1).alias("line"), place.alias("pos"), place.alias("seq"), "raw"
    )


def requests(t: Tables) -> DataFrame:
    """One chat request per document."""
    return _as_lines(documents(t), F.col("doc_id"), F.lit("requests.jsonl"), request_raw())


def indexed_requests(t: Tables) -> DataFrame:
    """The same requests, numbered by the scan itself instead of by a key."""
    rows = indexed_table(t.documents.select("doc_id", "text", "lang", "n_chars"))
    return computed_once(spread(rows, "line"), "raw", request_raw())


def _json(**members: Column) -> Column:
    fields = F.struct(*[c.alias(k) for k, c in members.items()])
    return F.to_json(fields, {"ignoreNullFields": "false"})


def _usage() -> Column:
    return F.struct(
        F.col("n_chars").alias("prompt_tokens"),
        F.col("doc_id").alias("completion_tokens"),
        (F.col("n_chars") + F.col("doc_id")).alias("total_tokens"),
    )


def _body(content: Column) -> Column:
    message = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    choice = F.struct(F.lit(0).alias("index"), message.alias("message"))
    return F.struct(F.array(choice).alias("choices"), _usage().alias("usage"))


def _error(cid: Column) -> Column:
    return _json(custom_id=cid, error=F.struct(F.lit("overloaded").alias("code")))


def success_raw() -> Column:
    """A result in the nested shape."""
    return _json(custom_id=doc_id(), response=F.struct(_body(F.col("text")).alias("body")))


def results_a_raw() -> Column:
    """Nested shape; documents of src4 came back as errors."""
    return F.when(F.col("source") == "src4", _error(doc_id())).otherwise(success_raw())


def results_a(t: Tables) -> DataFrame:
    return _as_lines(documents(t), F.col("doc_id"), F.lit("a.jsonl"), results_a_raw())



def results_b(t: Tables) -> DataFrame:
    """Flat shape with differences by document attributes.

    French documents carry another id; German ones another content; src0 and src1 came back as
    errors, src1 with a later success line; src2 has null content; src3 has content parts.
    """
    cid = F.when(F.col("lang") == "fr", numbered("alt-", 6, "doc_id")).otherwise(doc_id())

    def line(content: Column) -> Column:
        return _json(id=F.concat(F.lit("r-"), cid), custom_id=cid, response_body=_body(content))

    text = F.when(F.col("lang") == "de", F.concat("text", F.lit(" (revised)"))).otherwise(F.col("text"))
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    source = F.col("source")
    first = (
        F.when(source.isin("src0", "src1"), _error(cid))
        .when(source == "src2", line(F.lit(None).cast("string")))
        .when(source == "src3", line(parts))
        .otherwise(line(text))
    )
    lines = F.array_compact(F.array(first, F.when(source == "src1", line(text))))
    rows = documents(t).select("doc_id", "source", F.posexplode(lines).alias("k", "raw"))
    place = F.col("doc_id") * 2 + F.col("k")
    return _as_lines(rows, place, F.lit("b.jsonl"), F.col("raw"))


def dirty_lines(t: Tables) -> DataFrame:
    """Request lines with faults by source; each source is a file of its own."""
    s = F.col("source")
    url, method = F.lit(CHAT_URL), F.lit(METHOD)
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    body = F.struct(model().alias("model"), messages.alias("messages"))
    good = request_raw()
    raw = (
        F.when(s == "src0", _json(method=method, url=url, body=body))
        .when(s == "src1", _json(custom_id=doc_id(), url=url, body=body))
        .when(s == "src2", _json(custom_id=doc_id(), method=method, url=url))
        .when(s == "src3", _json(custom_id=doc_id(), method=method, url=url, body=F.struct(messages.alias("messages"))))
        .when(s == "src4", F.expr("left({0}, length({0}) - 1)".format("_good")))
        .when(s == "src5", F.concat("_good", F.lit(" x")))
        .when(s == "src6", F.lit(" \t "))
        .when(s == "src7", F.lit("[1]"))
        .when(s == "src8", _json(custom_id=doc_id(), method=method, url=url, body=F.col("text")))
        .when(s == "src9", _json(custom_id=F.lit(None).cast("string"), method=F.lit(1), url=url, body=body))
        .otherwise(F.col("_good"))
    )
    return _as_lines(documents(t).withColumn("_good", good), F.col("doc_id"), F.concat("source", F.lit(".jsonl")), raw)


def nested_lines(t: Tables) -> DataFrame:
    """Request lines whose nesting, by the length of their document, is about as deep as is allowed."""
    levels = (F.lit(110) + F.col("n_chars") % 30).cast("int")
    whole = _json(custom_id=doc_id(), method=F.lit(METHOD), url=F.lit(CHAT_URL), body=F.struct(model().alias("model"), F.lit("[{").alias("x")))
    raw = F.replace(whole, F.lit('"[{"'), F.concat(F.repeat(F.lit("["), levels), F.lit('"[{"'), F.repeat(F.lit("]"), levels)))
    return _as_lines(documents(t), F.col("doc_id"), F.lit("nested.jsonl"), raw)


def _page_path() -> Column:
    """Where a page is stored: below its id, as an address may have been fetched more than once."""
    return F.when(F.col("url").isNotNull(), F.concat_ws("/", "page_id", "url"))


def multimodal_requests(t: Tables) -> DataFrame:
    """One request per page: a text part, the page as an image reference, a finished data URI."""

    def part(kind: str, text: Column | None, url: Column | None) -> Column:
        none = F.lit(None).cast("string")
        link = F.struct((none if url is None else url).alias("url"))
        return F.struct(
            F.lit(kind).alias("type"),
            (none if text is None else text).alias("text"),
            (F.when(F.lit(url is not None), link)).alias("image_url"),
        )

    parts = F.array(
        part("text", F.col("url"), None),
        part("image_url", None, _page_path()),
        part("image_url", None, F.lit("data:image/png;base64,AA==")),
    )
    message = F.struct(F.lit("user").alias("role"), parts.alias("content"))
    body = F.struct(F.lit("m-vision").alias("model"), F.array(message).alias("messages"))
    raw = F.to_json(
        F.struct(
            numbered("page-", 6, "page_id").alias("custom_id"),
            F.lit(METHOD).alias("method"),
            F.lit(CHAT_URL).alias("url"),
            body.alias("body"),
        )
    )
    return _as_lines(spread(t.pages, "page_id"), F.col("page_id"), F.lit("pages.jsonl"), raw)


def blobs(t: Tables) -> DataFrame:
    return t.pages.select(_page_path().alias("path"), F.encode("html", "UTF-8").alias("bytes"))


def structured_results(t: Tables) -> DataFrame:
    """Results whose content is JSON text; for error events it is not."""
    content = F.when(F.col("event_type") == "error", F.concat(F.lit("oops "), "props")).otherwise(F.col("props"))
    message = F.struct(content.alias("content"))
    body = F.struct(F.array(F.struct(message.alias("message"))).alias("choices"))
    raw = _json(custom_id=numbered("event-", 8, "event_id"), response=F.struct(body.alias("body")))
    return _as_lines(spread(t.events, "event_id"), F.col("event_id"), F.lit("events.jsonl"), raw)


def price(text: str) -> Column:
    return F.lit(text).cast("decimal(18,15)")


def request_log(t: Tables) -> DataFrame:
    """The request log: one row per event, tokens from ``props``, no batch for sign-ups and no
    price for views."""
    kind = F.col("event_type")
    prompt = F.get_json_object("props", "$.k").cast("bigint")
    duration = F.round(F.col("value") * 100).cast("bigint")
    batch = F.concat(F.lit("batch-"), F.col("user_id").cast("string"))
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("m-"), kind).alias("model"),
        F.when(kind == "error", 500).otherwise(200).alias("status_code"),
        duration.alias("duration_ms"),
        prompt.alias("prompt_tokens"),
        (prompt * 2).alias("completion_tokens"),
        (prompt * 3).alias("total_tokens"),
        F.when(kind != "error", F.expr(f"CAST(ROUND(value * 100) AS BIGINT) DIV 10")).alias("ttfb_ms"),
        F.when(kind != "signup", batch).alias("batch_id"),
        F.when(kind != "view", price("0.000000150000000")).alias("input_price_per_token"),
        F.when(kind != "view", price("0.000000600000001")).alias("output_price_per_token"),
    )


# model, window, input price, output price; m-es is left out on purpose.
PRICES = [
    ("m-de", "24h", "0.000000100000000", "0.000000400000000"),
    ("m-en", "24h", "0.000000150000000", "0.000000600000001"),
    ("m-fr", "24h", "0.000000200000003", "0.000000800000000"),
    ("m-de", "1h", "0.000000200000000", "0.000000800000000"),
    ("m-en", "1h", "0.000000300000000", "0.000001200000000"),
    ("m-fr", "1h", "0.000000400000000", "0.000001600000000"),
]

# Realtime prices of the log's models; m-error is left out on purpose.
REALTIME = [
    ("m-click", "0.000000300000000", "0.000001200000007"),
    ("m-purchase", "0.000000300000000", "0.000001200000000"),
    ("m-signup", "0.000000500000000", "0.000001500000000"),
    ("m-view", "0.000000700000000", "0.000002100000000"),
]


def prices(t: Tables) -> DataFrame:
    columns = "model string, completion_window string, input_price string, output_price string"
    return literal_rows(t.spark, PRICES, columns)


def realtime_prices(t: Tables) -> DataFrame:
    return literal_rows(t.spark, REALTIME, "model string, input_price string, output_price string")


def batches(t: Tables) -> DataFrame:
    """Batches from orders, their counts from the order's lines."""
    counts = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("failed"),
        F.count_if(F.col("l_linestatus") == "F").alias("ended"),
    )
    status = F.expr("CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'validating' END")
    joined = t.orders.join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    zero = F.lit(0).cast("bigint")
    total, failed, ended = (F.coalesce(F.col(c), zero) for c in ("total", "failed", "ended"))
    return joined.select(
        F.col("o_orderkey").alias("id"),
        status.alias("status"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("created_at"),
        F.struct(total.alias("total"), (ended - failed).alias("completed"), failed.alias("failed")).alias("request_counts"),
    )


def models(t: Tables) -> DataFrame:
    return t.part.select(
        uuid_of("p_partkey").alias("id"), F.col("p_name").alias("alias"), F.col("p_type").alias("model_type")
    )


def uuid_of(key: str) -> Column:
    return F.format_string("00000000-0000-0000-0000-%012d", key)


def files(t: Tables) -> DataFrame:
    balance = F.col("s_acctbal")
    purpose = F.when(balance < 0, "batch_error").when(balance < 5000, "batch_output").otherwise("batch")
    return t.supplier.select(
        F.concat(F.lit("file-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.round(balance * 100).cast("bigint").alias("bytes"),
        F.col("s_suppkey").alias("created_at"),
        F.col("s_name").alias("filename"),
        purpose.alias("purpose"),
    )
