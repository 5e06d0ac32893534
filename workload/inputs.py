"""The given tables, seen as the inputs of the operators.

Amounts are taken in whole cents, so that sums are exact in double arithmetic
and do not depend on the order in which tasks finish.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.operators.windows import year_windows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100)


def comma_text(amount: Column) -> Column:
    """``1234.5`` as ``1234,50``."""
    return F.translate(amount.cast("decimal(18,2)").cast("string"), ".", ",")


def br_text(date: Column) -> Column:
    return F.date_format(date, "dd/MM/yyyy")


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped: one series per order priority."""
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("serie_codigo"),
        F.col("o_orderpriority").alias("serie_nome"),
        F.to_date("o_orderdate").alias("data"),
        cents("o_totalprice").alias("valor"),
    )


def customer_series(spark: SparkSession, sf_dir: str, pending_as_zero: bool = True) -> DataFrame:
    """Silver-shaped: one sparse series per customer."""
    pending = (F.col("o_orderstatus") == "P") & F.lit(pending_as_zero)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("serie_codigo"),
        F.concat(F.lit("cliente_"), F.col("o_custkey")).alias("serie_nome"),
        F.to_date("o_orderdate").alias("data"),
        F.when(pending, F.lit(0.0)).otherwise(cents("o_totalprice")).alias("valor"),
    )


def lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped: one series per return flag."""
    return table(spark, sf_dir, "lineitem").select(
        F.ascii("l_returnflag").alias("serie_codigo"),
        F.col("l_returnflag").alias("serie_nome"),
        F.to_date("l_shipdate").alias("data"),
        cents("l_extendedprice").alias("valor"),
    )


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped, with defects: low values of some types lose date, value or name."""
    kind, value = F.col("event_type"), F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("serie_codigo"),
        F.when(~((kind == "view") & (value < 5)), kind).alias("serie_nome"),
        F.when(~((kind == "signup") & (value < 5)), F.to_date("ts")).alias("data"),
        F.when((kind == "error") & (value < 5), F.lit(None))
        .when((kind == "click") & (value < 5), F.lit(float("nan")))
        .otherwise(value)
        .alias("valor"),
    )


def record_text(date: Column, amount: Column) -> Column:
    """One record as JSON; the texts need no escapes."""
    return F.concat(
        F.lit('{"data":"'), br_text(date), F.lit('","valor":"'), amount, F.lit('"}')
    )


def order_body(amount: Column) -> Column:
    """Two records per order: on the order date and a week later."""
    day = F.to_date("o_orderdate")
    return F.concat(
        F.lit("["),
        record_text(day, amount),
        F.lit(","),
        record_text(F.date_add(day, 7), amount),
        F.lit("]"),
    )


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages: one per order, in the series of its customer.

    The request failed for pending orders above 480,000.
    """
    failed = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 480000)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("codigo"),
        F.concat(F.lit("cliente_"), F.col("o_custkey")).alias("nome"),
        F.to_date("o_orderdate").alias("janela_inicio"),
        F.col("o_orderkey").alias("pagina"),
        F.when(failed, 503).otherwise(200).alias("status"),
        order_body(comma_text(F.col("o_totalprice"))).alias("body"),
    )


def window_pages(spark: SparkSession, sf_dir: str, empty_windows: bool) -> DataFrame:
    """Landed pages of yearly windows: every order, in the window of its customer.

    A window runs from a customer's first order on. One without orders lands as
    an empty list, or not at all.
    """
    orders = customer_pages(spark, sf_dir).select(
        F.col("codigo").alias("_codigo"), F.col("janela_inicio").alias("_dia"),
        "pagina", "status", "body",
    )
    windows = year_windows(customer_catalog(spark, sf_dir))
    inside = (F.col("codigo") == F.col("_codigo")) & F.col("_dia").between(
        F.col("janela_inicio"), F.col("janela_fim")
    )
    return windows.join(orders, inside, "left" if empty_windows else "inner").select(
        "codigo",
        "janela_inicio",
        F.coalesce("pagina", F.lit(0).cast("long")).alias("pagina"),
        F.coalesce("status", F.lit(200)).alias("status"),
        F.coalesce("body", F.lit("[]")).alias("body"),
    )


def open_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog: each customer from its first order, closed only if its last one was taken up.

    The end is absent where the last order is pending, and empty where it is finished.
    """
    last = F.struct("o_orderdate", "o_orderkey")
    by_customer = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("codigo")).agg(
        F.min("o_orderdate").alias("inicio"),
        F.max("o_orderdate").alias("fim"),
        F.max_by("o_orderstatus", last).alias("estado"),
    )
    end = F.when(F.col("estado") == "F", "").when(
        F.col("estado") != "P", br_text(F.to_date("fim"))
    )
    return by_customer.select(
        F.col("codigo").cast("int").alias("codigo"),
        F.concat(F.lit("cliente_"), F.col("codigo")).alias("nome"),
        br_text(F.to_date("inicio")).alias("data_inicial"),
        end.alias("data_final"),
    )


def broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents as text, cut off in the middle for pending orders."""
    whole = F.concat(F.lit('{"codigo":'), F.col("o_custkey"), F.lit(',"nome":"c","registros":[]}'))
    cut = F.concat(F.lit('{"codigo":'), F.col("o_custkey"), F.lit(',"nome":"c'))
    return table(spark, sf_dir, "orders").select(
        F.lit(0).alias("serie"),
        F.lit("2026-07-23").alias("data_ingestao"),
        F.when(F.col("o_orderstatus") == "P", cut).otherwise(whole).alias("value"),
    )


def segment_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped: one series per market segment and nation, so many months have none."""
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("c_nationkey").alias("serie_codigo"),
        F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("serie_nome"),
        F.to_date("o_orderdate").alias("data"),
        cents("o_totalprice").alias("valor"),
    )


def priority_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of three ingestion days: one per order, series by priority.

    Values are cents; finished orders have no usable value.
    """
    text = F.when(F.col("o_orderstatus") == "F", F.lit("n/d")).otherwise(
        F.concat(cents("o_totalprice").cast("long").cast("string"), F.lit(",0"))
    )
    return table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("codigo"),
        F.col("o_orderpriority").alias("nome"),
        F.to_date("o_orderdate").alias("janela_inicio"),
        F.col("o_orderkey").alias("pagina"),
        F.lit(200).alias("status"),
        order_body(text).alias("body"),
        F.when(F.col("o_orderstatus") == "P", "2026-07-23")
        .when(F.col("o_orderstatus") == "F", "2026-07-22")
        .otherwise("2026-07-20")
        .alias("dia"),
    )


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages: one per event, with good and bad answers by event type."""
    kind, props = F.col("event_type"), F.col("props")
    record = record_text(F.to_date("ts"), comma_text(F.col("value")))
    body = (
        F.when(kind == "error", "unavailable")
        .when(kind == "signup", props)
        .when(kind == "view", F.concat(F.lit("["), props))
        .when(kind == "click", F.concat(F.lit("["), props, F.lit(","), props, F.lit("]")))
        .otherwise(F.concat(F.lit("["), record, F.lit("]")))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("codigo"),
        kind.alias("nome"),
        F.to_date("ts").alias("janela_inicio"),
        F.col("event_id").alias("pagina"),
        F.when(kind == "error", 500).otherwise(200).alias("status"),
        body.alias("body"),
    )


def customer_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog: each customer from first to last order."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("codigo"))
        .agg(F.min("o_orderdate").alias("inicio"), F.max("o_orderdate").alias("fim"))
        .select(
            "codigo",
            F.concat(F.lit("cliente_"), F.col("codigo")).alias("nome"),
            br_text(F.to_date("inicio")).alias("data_inicial"),
            br_text(F.to_date("fim")).alias("data_final"),
        )
    )


def price_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog: each customer from the dearest to the cheapest order.

    About half of these intervals end before they start.
    """
    price = F.struct("o_totalprice", "o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("codigo"))
        .agg(
            F.max_by("o_orderdate", price).alias("inicio"),
            F.min_by("o_orderdate", price).alias("fim"),
        )
        .select(
            "codigo",
            F.concat(F.lit("cliente_"), F.col("codigo")).alias("nome"),
            F.date_format("inicio", "d/M/yyyy").alias("data_inicial"),
            F.date_format("fim", "d/M/yyyy").alias("data_final"),
        )
    )
