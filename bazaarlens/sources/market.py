"""Marketplace tables derived from the generic order/line/part tables of the test data.

The nine logical tables (orders, items, payments, reviews, customers, products, sellers,
geolocation, category translation) are computed from keys by arithmetic only, so the same rows
can be written in SQL. `landing_*` gives the raw form: all text, with defects a cleaner must meet.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHIFT_DAYS = 7305  # moves the 1995-2001 order dates to 2015-2021
MARKET_STATES = [  # by nation key
    "SP", "RJ", "MG", "ES", "PR", "SC", "RS", "BA", "PE", "CE", "MA", "PB", "PI",
    "RN", "AL", "SE", "DF", "GO", "MT", "MS", "AM", "PA", "AC", "AP", "RO",
]
CITIES = ["sao paulo", "São  Paulo", "EMBU-GUAÇU", " rio de janeiro ", "Belo Horizonte"]


def plus_days(ts: Column, days: Column | int) -> Column:
    return ts + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days.cast("int"))


def plus_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def nth(values: list[str], index: Column) -> Column:
    """values[index] for a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def dec(c: Column) -> Column:
    return c.cast("decimal(12,2)")


class Market:
    """Lazy bundle of the logical tables over one directory of Parquet files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    # --- typed tables -------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        status = (
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise(nth(["canceled", "created", "processing", "unavailable"], k % 4))
        )
        bought = plus_days(F.col("o_orderdate"), SHIFT_DAYS) + F.make_dt_interval(
            F.lit(0), (k % 24).cast("int"), (k % 60).cast("int")
        )
        base = self.table("orders").select(
            k.alias("k"),
            k.cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            status.alias("order_status"),
            bought.alias("p"),
        )
        sent = F.col("order_status").isin("delivered", "shipped")
        return base.select(
            "order_id",
            "customer_id",
            "order_status",
            F.col("p").alias("order_purchase_timestamp"),
            F.when(F.col("k") % 90 != 0, plus_days(F.col("p"), F.col("k") % 3)).alias("order_approved_at"),
            F.when(sent, plus_days(F.col("p"), F.col("k") % 5 + 2)).alias("order_delivered_carrier_date"),
            F.when(
                F.col("order_status") == "delivered",
                plus_hours(plus_days(F.col("p"), F.col("k") % 30 + 4), F.col("k") % 7),
            ).alias("order_delivered_customer_date"),
            plus_days(F.date_trunc("day", F.col("p")).cast("timestamp_ntz"), 25).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        price = dec(F.col("l_extendedprice"))
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            plus_days(F.col("l_shipdate"), SHIFT_DAYS).alias("shipping_limit_date"),
            price.alias("price"),
            dec(F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)).alias("freight_value"),
        )

    @cached_property
    def order_payments(self) -> DataFrame:
        k, seq = F.col("o_orderkey"), F.col("payment_sequential")
        cents = (F.col("o_totalprice").cast("decimal(12,2)") * 100).cast("bigint")
        part = F.when(k % 2 == 0, cents).otherwise(F.floor(cents / 2))
        return (
            self.table("orders")
            .select("o_orderkey", "o_totalprice", F.explode(F.sequence(F.lit(1), (k % 2 + 1).cast("int"))).alias("payment_sequential"))
            .select(
                k.cast("string").alias("order_id"),
                seq,
                nth(["credit_card", "boleto", "voucher", "debit_card", "not_defined"], (k + seq) % 5).alias("payment_type"),
                (k % 12 + 1).cast("int").alias("payment_installments"),
                dec(part.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(3,2)")).alias("payment_value"),
            )
        )

    @cached_property
    def order_reviews(self) -> DataFrame:
        k = F.col("o_orderkey")
        talks = self.table("conversations")
        # the reviews of a conversation take its turns in rotation, so every turn is some review's text
        texts = talks.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
        lengths = talks.groupBy(F.col("conv_id").alias("talk")).agg(F.count("*").alias("n_turns"))
        n_talks = talks.select(F.max("conv_id") + 1).scalar()
        copies = F.when((k % 40 == 0) & (k % 60 == 0), F.array(F.lit(0), F.lit(1), F.lit(2)))
        copies = copies.when(k % 40 == 0, F.array(F.lit(0), F.lit(1))).when(k % 60 == 0, F.array(F.lit(0), F.lit(2)))
        created = plus_days(F.col("o_orderdate"), SHIFT_DAYS + 35)
        answer_hours = F.when(k % 97 == 0, F.lit(-3)).otherwise(k % 72) + F.col("c") * 5
        base = (
            self.table("orders")
            .where(k % 10 < 8)
            .select(k, "o_orderdate", F.explode(copies.otherwise(F.array(F.lit(0)))).alias("c"))
            .withColumn("talk", k % n_talks)
            .withColumn("nth_use", F.floor(k / n_talks))
            .join(lengths, "talk", "left")
        )
        return base.join(texts, (F.col("talk") == F.col("conv_id")) & (F.col("nth_use") % F.col("n_turns") == F.col("turn")), "left").select(
            F.concat(F.when(F.col("c") == 2, "x").otherwise("r"), k.cast("string")).alias("review_id"),
            k.cast("string").alias("order_id"),
            F.when(k % 111 == 0, 6).otherwise(k * 7 % 5 + 1).cast("int").alias("review_score"),
            F.when(k % 5 >= 3, F.concat(F.lit(" Titulo "), (k % 100).cast("string"))).alias("review_comment_title"),
            F.when(k % 5 >= 2, F.col("text")).alias("review_comment_message"),
            created.alias("review_creation_date"),
            plus_hours(created, answer_hours).alias("review_answer_timestamp"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        uf = nth(MARKET_STATES, F.col("c_nationkey"))
        return self.table("customer").select(
            k.cast("string").alias("customer_id"),
            (k - F.when(k % 10 == 9, 1).otherwise(0)).cast("string").alias("customer_unique_id"),
            (k * 37 % 20000).cast("string").alias("customer_zip_code_prefix"),
            nth(CITIES, k % 5).alias("customer_city"),
            F.when(k % 101 == 0, "ZZ").when(k % 20 == 3, F.concat(F.lower(uf), F.lit(" "))).otherwise(uf).alias("customer_state"),
        )

    @cached_property
    def products(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.cast("string").alias("product_id"),
            F.when(k % 50 != 0, self._category()).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (k % 400 + 100).cast("int").alias("product_description_lenght"),
            F.when(k % 50 != 0, k % 6 + 1).cast("int").alias("product_photos_qty"),
            F.when(k % 61 != 0, F.col("p_size") * 250).cast("double").alias("product_weight_g"),
            F.when(k % 61 != 0, k % 10 + 10).cast("double").alias("product_length_cm"),
            (k % 4 + 5).cast("double").alias("product_height_cm"),
            (k % 6 + 8).cast("double").alias("product_width_cm"),
        )

    @staticmethod
    def _category() -> Column:
        return F.concat(F.lower("p_type"), F.lit("_"), F.lower(F.translate("p_brand", "#", "_")))

    @cached_property
    def translation(self) -> DataFrame:
        """One row per category of five of the six types; some keys carry a trailing space."""
        english = F.concat(F.lower("p_type"), F.lit("_"), F.lower(F.regexp_replace("p_brand", "Brand#", "line_")))
        number = F.regexp_replace("p_brand", "Brand#", "").cast("int")
        return (
            self.table("part")
            .where("p_type <> 'ECONOMY'")
            .select(
                F.when(number % 5 == 0, F.concat(self._category(), F.lit(" "))).otherwise(self._category()).alias("product_category_name"),
                english.alias("product_category_name_english"),
            )
            .distinct()
        )

    @cached_property
    def sellers(self) -> DataFrame:
        k = F.col("s_suppkey")
        uf = nth(MARKET_STATES, F.col("s_nationkey"))
        return self.table("supplier").select(
            k.cast("string").alias("seller_id"),
            (k * 53 % 20000).cast("string").alias("seller_zip_code_prefix"),
            nth(CITIES, k % 5).alias("seller_city"),
            F.when(k % 20 == 3, F.concat(F.lower(uf), F.lit(" "))).otherwise(uf).alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        k, i = F.col("c_custkey"), F.col("i")
        lat = ((k * 13 + i * 7) % 3900 - 3000) / F.lit(100.0)
        lng = ((k * 17 + i * 3) % 4400 - 7400) / F.lit(100.0)
        return (
            self.table("customer")
            .select(k, "c_nationkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
            .select(
                (k * 37 % 20000).cast("string").alias("geolocation_zip_code_prefix"),
                F.when((k % 300 != 5) | (i > 0), lat).alias("geolocation_lat"),
                lng.alias("geolocation_lng"),
                nth(CITIES, F.when(i == 2, k + 1).otherwise(k + i) % 5).alias("geolocation_city"),
                nth(MARKET_STATES, F.col("c_nationkey")).alias("geolocation_state"),
            )
        )

    # --- raw text form with defects ----------------------------------------
    @staticmethod
    def as_text(df: DataFrame) -> DataFrame:
        return df.select([F.col(c).cast("string").alias(c) for c in df.columns])

    @cached_property
    def landing_orders(self) -> DataFrame:
        k = F.col("order_id").cast("bigint")
        again = self.orders.where(k % 200 == 7).withColumns(
            {
                "order_status": F.concat(F.lit(" "), "order_status", F.lit(" ")),
                "order_purchase_timestamp": plus_hours(F.col("order_purchase_timestamp"), F.lit(1)),
            }
        )
        text = self.as_text(self.orders.unionByName(again))
        return text.withColumns(
            {
                "order_approved_at": F.when(k % 70 == 3, "2018-13-01 00:00:00").otherwise(F.col("order_approved_at")),
                "order_status": F.when(k % 501 == 2, "lost").otherwise(F.col("order_status")),
                "customer_id": F.when(k % 333 != 1, F.col("customer_id")),
            }
        )

    @cached_property
    def landing_order_items(self) -> DataFrame:
        k = F.col("order_id").cast("bigint") + F.col("order_item_id")
        price = (
            F.when(k % 97 == 0, "abc")
            .when(k % 89 == 0, "0")
            .when(k % 83 == 0, "-1")
            .when(k % 79 == 0, "12.345")
            .otherwise(F.col("price").cast("string"))
        )
        return self.as_text(self.order_items.withColumn("price", price)).withColumn(
            "product_id", F.when((F.length("order_id") > 1) | (F.col("order_item_id") != "1"), F.col("product_id"))
        )

    @cached_property
    def landing_order_payments(self) -> DataFrame:
        k = F.col("order_id").cast("bigint")
        df = self.order_payments.withColumns(
            {
                "payment_type": F.when(k % 30 == 4, F.concat(F.lit(" "), F.upper("payment_type"))).otherwise(F.col("payment_type")),
                "payment_value": F.when(k % 101 == 0, F.lit("0")).otherwise(F.col("payment_value").cast("string")),
                "payment_installments": F.when(k % 77 != 0, F.col("payment_installments").cast("string")),
            }
        )
        return self.as_text(df)

    @cached_property
    def landing_order_reviews(self) -> DataFrame:
        score = F.col("review_score").cast("string")
        score = F.when(F.col("order_id").cast("bigint") % 9 == 0, F.concat(score, F.lit(".0"))).otherwise(score)
        return self.as_text(self.order_reviews.withColumn("review_score", score))

    @cached_property
    def landing_products(self) -> DataFrame:
        k = F.col("product_id").cast("bigint")
        weight = F.when(k % 45 == 0, "heavy").otherwise(F.col("product_weight_g").cast("string"))
        length = F.when(k % 47 == 0, "10.5").otherwise(F.col("product_length_cm").cast("string"))
        return self.as_text(self.products.withColumns({"product_weight_g": weight, "product_length_cm": length}))

    @cached_property
    def landing_geolocation(self) -> DataFrame:
        return self.as_text(self.geolocation)

    # --- text, extraction answers, vectors, assets --------------------------
    @cached_property
    def product_texts(self) -> DataFrame:
        """Title from the part name, description from a whole document. The parts are dealt over all cores before they meet
        their texts, so that no text is moved once per part."""
        from bazaarlens.operators.extraction import spread

        docs = self.table("documents").select("doc_id", F.col("text").alias("description"))
        n_docs = self.table("documents").select(F.max("doc_id") + 1).scalar()
        parts = spread(self.table("part")).select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat_ws(" ", "p_name", "p_brand", F.lower("p_type")).alias("title"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
            (F.col("p_partkey") % n_docs).alias("doc"),
        )
        return parts.join(docs, F.col("doc") == F.col("doc_id"), "left").select("product_id", "title", "description", "price")

    @cached_property
    def answers(self) -> DataFrame:
        """Answer text per product as an extractor would return it, good and bad forms."""
        from bazaarlens.functions.fixed import PRODUCT_CATEGORIES

        k = F.col("p_partkey")
        category = F.when(k % 29 == 0, "Unknown Stuff").otherwise(nth(PRODUCT_CATEGORIES, k % 16))
        words = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.when(i < k % 12, F.concat(F.lit("kw"), i.cast("string")))),
            lambda w: w.isNotNull(),
        )
        flags = F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(8)), lambda i: i < k % 9),
            lambda i: F.concat(F.lit('"has_f'), i.cast("string"), F.lit('": '), F.when((k + i) % 3 == 0, "false").otherwise("true")),
        )
        extra = F.when(k % 31 == 0, F.array(F.lit('"size": "big"'))).otherwise(F.array().cast("array<string>"))
        features = F.when(k % 19 == 0, "[1, 2]").otherwise(
            F.concat(F.lit("{"), F.array_join(F.concat(flags, extra), ", "), F.lit("}"))
        )
        keywords = F.when(k % 23 == 0, '"one text"').otherwise(
            F.concat(F.lit("["), F.array_join(F.transform(words, lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", "), F.lit("]"))
        )
        text_or_null = lambda cond, value: F.when(cond, F.concat(F.lit('"'), value, F.lit('"'))).otherwise("null")
        body = F.concat(
            F.lit('{"category": "'), category, F.lit('", "subcategory": "'), F.col("p_name"), F.lit('", '),
            F.when(k % 13 != 0, F.concat(F.lit('"brand": '), text_or_null(k % 7 != 0, F.col("p_brand")), F.lit(", "))).otherwise(""),
            F.lit('"material": '), text_or_null(k % 4 != 0, nth(["Leather", "Steel", "None", ""], F.floor(k / 4) % 4)),
            F.lit(', "target_device": '), text_or_null(k % 3 == 0, F.lit("Phone")),
            F.lit(', "color": '), text_or_null(k % 5 != 0, nth(["Black", "Red", "Blue"], k % 3)),
            F.lit(', "features": '), features,
            F.lit(', "target_audience": '), text_or_null(k % 6 == 0, F.lit("Unisex")),
            F.lit(', "keywords": '), keywords, F.lit("}"),
        )
        raw = F.when(k % 37 == 0, None).when(k % 17 == 0, F.concat(F.lit("oops "), F.col("p_name"))).otherwise(body)
        return self.table("part").select(
            k.cast("string").alias("product_id"),
            F.concat_ws(" ", "p_name", "p_brand", F.lower("p_type")).alias("title"),
            raw.alias("answer"),
            (k % 200 + 500).cast("bigint").alias("input_tokens"),
            (k % 100 + 150).cast("bigint").alias("output_tokens"),
        )

    @cached_property
    def embeddings(self) -> DataFrame:
        v = F.col("vec_id")
        return self.table("embeddings").select(
            v.cast("string").alias("product_id"),
            "embedding",
            F.when(v % 10 != 0, F.concat(F.lit("class_"), F.col("label").cast("string"))).alias("extracted_category"),
            ((v % 50 + 50) / F.lit(100.0)).alias("confidence_score"),
        )

    @cached_property
    def assets(self) -> DataFrame:
        d = F.col("doc_id")
        kind = nth(["Table", "dashboard", "PIPELINE"], d % 3)
        return self.table("documents").select(
            d.alias("id"),
            F.concat_ws(" ", F.lit("Asset"), "source", d.cast("string")).alias("name"),
            F.when(d % 4 == 0, kind).alias("type"),
            F.when(d % 4 == 1, kind).alias("asset_type"),
            F.when(d % 4 == 2, kind).alias("assetType"),
            F.col("text").alias("description"),
            F.array("lang", "source").alias("tags"),
        )
