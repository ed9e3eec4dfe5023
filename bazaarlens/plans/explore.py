"""Exploratory profiles and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from bazaarlens.functions import scalars as S
from bazaarlens.operators import aggregates as A
from bazaarlens.operators import joins as J
from bazaarlens.operators.ranges import exact_quantiles
from bazaarlens.sources.io import stage


def table_profile(name: str, df: DataFrame) -> DataFrame:
    """One row per column with type and nulls, from one pass over the table."""
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col("n_rows"),
            (F.col("n_rows") - F.col(f"c{i}")).alias("n_nulls"),
            S.percent(F.col("n_rows") - F.col(f"c{i}"), "n_rows").alias("pct_nulls"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_profile(n, df) for n, df in tables.items()])


def quality_profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, columns, repeated full rows, columns with nulls; rows are grouped once."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    filled = [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_n"))), F.lit(0)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    row = groups.agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_distinct"), *filled)
    with_nulls = reduce(lambda a, b: a + b, [(F.col(f"c{i}") > 0).cast("int") for i in range(len(df.columns))])
    return row.select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"),
        S.percent(F.col("n_rows") - F.col("n_distinct"), "n_rows").alias("pct_duplicates"),
        with_nulls.alias("n_columns_with_nulls"),
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    counts = A.value_counts(orders, "order_status")
    everything = orders.select(F.count("*")).scalar()
    return counts.withColumn("pct", S.percent(F.col("n"), everything)).orderBy(F.desc("n"), "order_status")


def monthly_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("year_month")).agg(F.count("order_id").alias("pedidos")).orderBy("year_month")


def order_values(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        S.money(F.sum("price")).alias("total_price"),
        S.money(F.sum("freight_value")).alias("total_freight"),
        F.count("order_item_id").alias("items_count"),
        S.money(F.sum(F.col("price") + F.col("freight_value"))).alias("total_order"),
    )


def order_value_summary(items: DataFrame) -> DataFrame:
    values = order_values(items)
    return values.agg(
        S.money(F.sum("total_price")).alias("receita_produtos"),
        S.money(F.sum("total_freight")).alias("frete_total"),
        S.money(F.sum("total_order")).alias("receita_total"),
        S.mean("total_order").alias("ticket_medio"),
        S.mean("items_count").alias("itens_por_pedido"),
    ).withColumn("ticket_mediano", F.round(exact_quantiles(values, "total_order", {"m": 0.5}).scalar(), 4))


def top_categories(items: DataFrame, products: DataFrame, translation: DataFrame, top: int = 15) -> DataFrame:
    named = products.join(translation, "product_category_name").select("product_id", "product_category_name_english")
    return (
        J.attach(items, named, "product_id", "inner")
        .groupBy("product_category_name_english")
        .agg(
            S.money(F.sum("price")).alias("receita"),
            F.count_distinct("order_id").alias("pedidos"),
            F.count("order_item_id").alias("items"),
            S.mean("price").alias("ticket_medio"),
        )
        .orderBy(F.desc("receita"), "product_category_name_english")
        .limit(top)
    )


def orders_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    joined = orders.select("order_id", "customer_id").join(customers.select("customer_id", "customer_state"), "customer_id", "left")
    counts = joined.where("customer_state is not null").groupBy("customer_state").agg(F.count("order_id").alias("pedidos"))
    everything = orders.select(F.count("*")).scalar()
    place = F.row_number().over(W.orderBy(F.desc("pedidos"), "customer_state"))
    return counts.withColumns({"pct": S.percent(F.col("pedidos"), everything), "posicao": place}).withColumn(
        "top5_pct", S.percent(F.sum(F.when(F.col("posicao") <= 5, F.col("pedidos"))).over(W.partitionBy()), everything)
    )


def payment_methods(payments: DataFrame) -> DataFrame:
    grouped = payments.where("payment_type is not null").groupBy("payment_type").agg(
        F.count("order_id").alias("transacoes"),
        S.money(F.sum("payment_value")).alias("valor_total"),
        S.mean("payment_value").alias("valor_medio"),
        S.mean("payment_installments").alias("parcelas_media"),
    )
    return A.share_of_total(grouped, "transacoes", "pct").orderBy(F.desc("transacoes"), "payment_type")


def installment_hist(payments: DataFrame) -> DataFrame:
    card = payments.where("payment_type = 'credit_card' and payment_installments between 1 and 24")
    return card.groupBy(F.least("payment_installments", F.lit(23)).alias("parcelas")).agg(F.count("*").alias("n"))


def review_scores(reviews: DataFrame) -> DataFrame:
    counts = A.share_of_total(A.value_counts(reviews, "review_score"), "n", "pct")
    summary = reviews.agg(S.mean("review_score").alias("nota_media"))
    return counts.withColumns(
        {"nota_media": summary.scalar(), "nota_mediana": exact_quantiles(reviews, "review_score", {"m": 0.5}).scalar()}
    ).orderBy("review_score")


def nps(reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    return reviews.agg(
        F.count_if(score >= 4).alias("promotores"),
        F.count_if(score == 3).alias("neutros"),
        F.count_if(score <= 2).alias("detratores"),
        S.percent(F.count_if(score >= 4) - F.count_if(score <= 2), F.count("*")).alias("nps"),
    )


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.where("order_status = 'delivered'").select(
        S.floor_days("order_purchase_timestamp", "order_delivered_customer_date").alias("days"),
        S.floor_days("order_estimated_delivery_date", "order_delivered_customer_date").alias("delay"),
    )


def delivery_metrics(orders: DataFrame) -> DataFrame:
    d = _delivered(orders)
    return d.agg(
        S.mean("days", 1).alias("tempo_medio"),
        F.count_if(F.col("delay") <= 0).alias("no_prazo"),
        S.percent(F.count_if(F.col("delay") <= 0), F.count("*"), 1).alias("pct_no_prazo"),
        F.count_if(F.col("delay") > 0).alias("atrasadas"),
        S.percent(F.count_if(F.col("delay") > 0), F.count("*"), 1).alias("pct_atrasadas"),
        S.mean(F.when(F.col("delay") > 0, F.col("delay")), 1).alias("atraso_medio"),
    ).withColumn("tempo_mediano", exact_quantiles(d, "days", {"m": 0.5}).scalar())


def delivery_hist(orders: DataFrame) -> DataFrame:
    clipped = _delivered(orders).select(S.clip("days", 0, 60).alias("days"))
    return A.histogram(clipped, "days", 0, 60, 30)


def executive_summary(m) -> DataFrame:
    """One row: every block is a one-row aggregate read as a scalar."""
    one = lambda df, c: df.select(c).scalar()
    count = lambda df: df.select(F.count("*")).scalar()
    blocks = {"values": order_value_summary(m.order_items), "scores": nps(m.order_reviews), "delivery": delivery_metrics(m.orders)}
    values, scores, delivery = (stage(df, f"summary_{name}") for name, df in blocks.items())  # small, read once per column
    states = stage(orders_by_state(m.orders, m.customers), "summary_states")
    top_state = states.where("posicao = 1")
    top_category = top_categories(m.order_items, m.products, m.translation, 1)
    return m.spark.range(1).select(
        count(m.orders).alias("pedidos"),
        count(m.order_items).alias("itens"),
        count(m.customers).alias("clientes"),
        count(m.products).alias("produtos"),
        count(m.sellers).alias("vendedores"),
        one(values, "receita_total").alias("receita_total"),
        one(values, "ticket_medio").alias("ticket_medio"),
        one(values, "ticket_mediano").alias("ticket_mediano"),
        m.order_reviews.select(S.mean("review_score")).scalar().alias("nota_media"),
        one(scores, "nps").alias("nps"),
        m.order_reviews.select(S.percent(F.count_if(F.col("review_score") >= 4), F.count("*"), 1)).scalar().alias("pct_promotores"),
        one(delivery, "tempo_medio").alias("tempo_medio"),
        one(delivery, "pct_no_prazo").alias("pct_no_prazo"),
        count(states).alias("estados"),
        one(top_state, "customer_state").alias("top_estado"),
        one(top_state, "pedidos").alias("top_estado_pedidos"),
        m.products.select(F.count_distinct("product_category_name")).scalar().alias("categorias"),
        one(top_category, "product_category_name_english").alias("top_categoria"),
    )
