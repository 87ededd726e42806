"""Test tables reshaped into the event model: purchase events, their items, users and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.ordered import asc
from martlet.operators.variant import AMOUNT, MONEY, nest
from martlet.sizing import limit, lookup_join, small_enough, stored, tasks_for

# Devices an event may come from, by order number.
DEVICE_SYSTEMS = ("iOS", "Android", "PC")
APP_VERSION = "2.0.0"

# Columns that put the lines of one order in a fixed sequence: later deliveries come last.
LINE_ORDER = (
    "l_shipdate", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_partkey",
)


def money(name: str) -> Column:
    return F.col(name).cast(AMOUNT)


def event_header(orders: DataFrame, *keep: str) -> DataFrame:
    """One row per purchase event, from one row per order; ``keep`` are further columns of the input."""
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("event_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("o_orderstatus") != "P", "purchase").otherwise("view").alias("event_type"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_time"),
        (F.col("o_orderdate").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))).alias("event_time"),
        F.when(key % 10 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("part-"), (key % 4).cast("string"), F.lit(".json")))
        .alias("src_filename"),
        F.when(key % 50 != 0, F.element_at(
            F.array(*[F.lit(s) for s in DEVICE_SYSTEMS]), (key % 3 + 1).cast("int"))
        ).alias("device_os"),
        "o_orderkey", *keep,
    )


def purchased_items(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with the product columns an event item carries."""
    joined = lookup_join(
        lineitem, part.select("p_partkey", "p_name", "p_type", "p_retailprice"),
        F.col("l_partkey") == F.col("p_partkey"),
    )
    return joined.select(
        "l_orderkey", *LINE_ORDER,
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )


def _whole_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame, per_document: int) -> DataFrame:
    """Events of orders whose lines one task can hold: one shuffle on the order brings header and lines together.

    The lines are put in sequence inside their order, so no row is numbered or sorted among others.
    """
    products = part.select("p_partkey", "p_name", "p_type", F.col("p_retailprice").cast(MONEY).alias("price"))
    lines, on = lineitem.select("l_orderkey", *LINE_ORDER), F.col("l_partkey") == F.col("p_partkey")
    tasks = tasks_for(lineitem)
    # Left joins, because an order is loaded when its last line is, a line without its product included.
    if small_enough(products):  # the shuffle then carries no product texts
        priced = lines.repartition(tasks, "l_orderkey").join(F.broadcast(products), on, "left")
    else:  # hashed products: the lines are not sorted for this join
        priced = lines.join(products.hint("shuffle_hash"), on, "left").repartition(tasks, "l_orderkey")
    line = F.struct(*LINE_ORDER, "p_name", "p_type", "price")
    gathered = priced.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list(F.when(F.col("p_partkey").isNotNull(), line))).alias("lines"),
        F.max("l_shipdate").cast("timestamp_ntz").alias("loaded_at"))
    items = gathered.withColumn("items", F.transform("lines", lambda line, i: F.struct(
        (i + 1).cast("bigint").alias("line_no"),
        line["l_partkey"].cast("string").alias("sku"),
        line["p_name"].alias("product_name"),
        line["p_type"].alias("category"),
        line["l_quantity"].cast("bigint").alias("qty"),
        line["price"].alias("price"),
    ))).drop("lines")
    both = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").join(items, "o_orderkey", "left")
    header = event_header(both, "items", "loaded_at")
    size = F.coalesce(F.size("items"), F.lit(0))
    filled = F.when(size > 0, F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / per_document).cast("int")),
        lambda n: F.struct(
            F.slice("items", n * per_document + 1, per_document).alias("items"),
            n.cast("bigint").alias("part"), F.col("loaded_at").alias("loaded_at"))))
    empty = F.when(F.col("loaded_at").isNull(), F.array(F.struct(
        F.from_json(F.lit("[]"), items.schema["items"].dataType).alias("items"),
        F.lit(0).cast("bigint").alias("part"), F.col("order_time").alias("loaded_at"))))
    documents = F.flatten(F.array_compact(F.array(filled, empty)))
    kept = [c for c in header.columns if c not in ("items", "loaded_at")]
    return header.select(*kept, F.inline(documents))


def _divided_orders(orders: DataFrame, lineitem: DataFrame, part: DataFrame, per_document: int) -> DataFrame:
    """The same for orders with more lines: these are numbered first, then gathered document by document."""
    items = nest(
        purchased_items(lineitem, part), ["l_orderkey"],
        ["sku", "product_name", "category", "qty", "price"], asc(*LINE_ORDER), {},
        max_items=per_document, part="part",
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    loads = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").cast("timestamp_ntz").alias("loaded_at"))
    header = event_header(orders).join(loads, "o_orderkey", "left")
    # As an inner join this can split an order that fills many documents; a left join could not, so the
    # orders without a load time are added separately.
    filled = items.join(header, "o_orderkey")
    empty = header.where(F.col("loaded_at").isNull()).withColumns({
        "items": F.from_json(F.lit("[]"), items.schema["items"].dataType),
        "part": F.lit(0).cast("bigint"),
        "loaded_at": F.col("order_time"),
    })
    return filled.unionByName(empty)


def event_documents(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Raw event documents as JSON text with their load metadata.

    Columns: ``line`` (one JSON object), ``src_filename``, ``loaded_at``. An order without lines has
    an empty item array. An order with more lines than a document holds has several documents: all but
    the first carry their number ``part`` and the number of items before them, ``offset``. One order in
    fifty reports its device as a plain string.
    """
    per_document = limit(orders.sparkSession, "documentItems")
    known = lineitem.where(F.col("l_orderkey").isNotNull())
    large = stored(known.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > per_document).select(F.col("l_orderkey").alias("_large")))
    if large.isEmpty():
        events = _whole_orders(orders, known, part, per_document)
    else:
        sides = [
            (lookup_join(orders, large, F.col("o_orderkey") == F.col("_large"), how),
             lookup_join(known, large, F.col("l_orderkey") == F.col("_large"), how))
            for how in ("left_anti", "left_semi")]
        events = _whole_orders(*sides[0], part, per_document).unionByName(
            _divided_orders(*sides[1], part, per_document))

    def document(device: Column) -> Column:
        return F.to_json(F.struct(
            "event_id", "user_id", "event_type",
            F.concat(F.translate(F.col("event_time").cast("string"), " ", "T"), F.lit("Z"))
            .alias("event_time"),
            device.alias("device"), "items",
            F.when(F.col("part") > 0, F.col("part")).alias("part"),
            F.when(F.col("part") > 0, F.col("part") * per_document).alias("offset"),
        ))

    as_object = F.struct(F.col("device_os").alias("os"), F.lit(APP_VERSION).alias("app_version"))
    return events.select(
        F.when(F.col("device_os").isNull(), document(F.lit("mobile")))
        .otherwise(document(as_object)).alias("line"),
        "src_filename", "loaded_at",
    )


def user_dimension(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """All users with a name and a prefecture."""
    return lookup_join(
        customer, nation.select("n_nationkey", "n_name"),
        F.col("c_nationkey") == F.col("n_nationkey"),
    ).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.col("n_name").alias("prefecture"),
    )
