"""Product catalogue and review pool from reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook.functions import values as V


def first_offer(items: DataFrame, row_order: list[str]) -> DataFrame:
    """Price, seller and freight of the first item of each product.

    ``min_by`` keeps one row per product and task before the shuffle.
    """
    offer = F.struct("price", "seller_id", "freight_value")
    return (
        items.groupBy("product_id")
        .agg(F.min_by(offer, F.struct(*row_order)).alias("o"))
        .select("product_id", "o.*")
    )


def product_catalog(
    products: DataFrame, items: DataFrame, translation: DataFrame, row_order: list[str]
) -> DataFrame:
    """Products that have a category and were sold, with the translated category.

    A category without a translation keeps its own name.
    """
    named = products.filter(V.present("product_category_name"))
    photos = F.coalesce(F.col("product_photos_qty").try_cast("int"), F.lit(1))
    joined = named.join(first_offer(items, row_order), "product_id").join(
        translation, "product_category_name", "left"
    )
    return joined.select(
        "product_id",
        F.col("product_category_name").alias("category_pt"),
        F.coalesce("product_category_name_english", "product_category_name").alias("category"),
        F.col("price").try_cast("double").alias("price"),
        "seller_id",
        F.col("freight_value").try_cast("double").alias("freight"),
        F.when(photos == 0, 1).otherwise(photos).alias("photos_qty"),
    )


def _stripped(column: str) -> Column:
    return F.btrim(F.coalesce(F.col(column), F.lit("")), F.lit(" \t\n\r\f\x0b"))


def review_pool(reviews: DataFrame) -> DataFrame:
    """Reviews with text."""
    return reviews.select(
        "review_id",
        F.col("review_score").try_cast("int").alias("review_score"),
        _stripped("review_comment_title").alias("title"),
        _stripped("review_comment_message").alias("message"),
    ).filter("message <> ''")
