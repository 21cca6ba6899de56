"""Views for readers without clearance. The caller says what the reader may see."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.masks import define, mask_coordinate, mask_customer_id, mask_free_text


def customer_secure(customers: DataFrame, cleared: bool = False) -> DataFrame:
    """Customers with a shortened person id and coarse coordinates unless ``cleared``."""
    if cleared:
        return customers
    define(customers.sparkSession)
    return customers.withColumns(
        {
            "customer_unique_id": mask_customer_id(F.col("customer_unique_id")),
            "customer_latitude": mask_coordinate(F.col("customer_latitude")),
            "customer_longitude": mask_coordinate(F.col("customer_longitude")),
        }
    )


def reviews_secure(reviews: DataFrame) -> DataFrame:
    """Review scores and flags; free text never leaves, whatever table it comes from."""
    return reviews.drop("review_comment_title", "review_comment_message")


def review_text_masked(reviews: DataFrame, cleared: bool = False) -> DataFrame:
    """Silver reviews with their text hidden but its presence visible."""
    if cleared:
        return reviews
    define(reviews.sparkSession)
    texts = ("review_comment_title", "review_comment_message")
    return reviews.withColumns({c: mask_free_text(F.col(c)) for c in texts})


def customer_regional(customers: DataFrame, states: Collection[str]) -> DataFrame:
    """Only the customers of the states the reader is responsible for."""
    return customers.filter(F.col("customer_state").isin(list(states)))


def create_views(
    spark: SparkSession, region: Collection[str], layer: str = "gold", into: str = "security"
) -> None:
    """The secure views as catalog views, for readers who query by SQL, and the masks as functions beside them.

    The catalog knows no reader groups, so grant ``into`` to everyone and ``layer`` only to
    cleared readers. ``region`` is the set of states the regional view shows.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {into}")
    define(spark, into)
    people = spark.table(f"{layer}.dim_customer").columns
    masks = {
        "customer_unique_id": "mask_id", "customer_latitude": "mask_coordinate", "customer_longitude": "mask_coordinate",
    }
    masks = {column: f"{into}.{mask}({column})" for column, mask in masks.items()}
    shown = ", ".join(f"{masks.get(c, c)} AS {c}" for c in people)
    scores = ", ".join(reviews_secure(spark.table(f"{layer}.fct_reviews")).columns)
    states = ", ".join("'" + state.replace("'", "\\'") + "'" for state in region)
    bodies = {
        "v_dim_customer_secure": f"SELECT {shown} FROM {layer}.dim_customer",
        "v_fct_reviews_secure": f"SELECT {scores} FROM {layer}.fct_reviews",
        "v_dim_customer_regional": f"SELECT * FROM {layer}.dim_customer"
        f" WHERE customer_state IN ({states or 'NULL'})",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE VIEW {into}.{name} AS {body}")
