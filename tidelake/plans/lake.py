"""Data sets by name, built lazily from bronze."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidelake.contracts import CALENDAR_RANGE
from tidelake.operators.expectations import drop_failing, rules_for
from tidelake.plans import gold, marts, security, silver

# Data set -> (builder, the data sets it reads).
BUILDERS = {
    **{
        name: (build, (f"br_{source}",))
        for name, build, source in (
            ("sv_orders", silver.typed_orders, "orders"),
            ("sv_order_items", silver.typed_order_items, "order_items"),
            ("sv_payments", silver.typed_payments, "payments"),
            ("sv_reviews", silver.typed_reviews, "reviews"),
            ("sv_quarantine_orders", silver.quarantined_orders, "orders"),
            ("sv_customer_keys", silver.typed_customer_keys, "customers"),
            ("sv_customers", silver.customers, "customers"),
            ("sv_geolocation", silver.geolocation, "geolocation"),
            ("sv_category_translation", silver.category_translation, "category_translation"),
            ("sv_sellers_history", silver.sellers_history, "sellers"),
            ("sv_products_history", silver.products_history, "products"),
        )
    },
    "dim_seller": (gold.dim_seller, ("sv_sellers_history", "sv_geolocation")),
    "dim_product": (gold.dim_product, ("sv_products_history", "sv_category_translation")),
    "dim_customer": (gold.dim_customer, ("sv_customers", "sv_geolocation")),
    "bridge_customer_order": (gold.bridge_customer_order, ("sv_customer_keys",)),
    "order_spine": (gold.order_spine, ("sv_orders", "bridge_customer_order")),
    "fct_order_items": (gold.fct_order_items, ("sv_order_items", "order_spine")),
    "fct_payments": (gold.fct_payments, ("sv_payments", "order_spine")),
    "fct_reviews": (gold.fct_reviews, ("sv_reviews", "order_spine")),
    "mart_delivery_performance": (
        marts.delivery_performance, ("fct_order_items", "dim_customer", "fct_reviews"),
    ),
    "mart_seller_scorecard": (
        marts.seller_scorecard, ("fct_order_items", "dim_seller", "fct_reviews"),
    ),
    "mart_monthly_revenue": (marts.monthly_revenue, ("fct_order_items", "dim_customer")),
    "v_dim_customer_secure": (security.customer_secure, ("dim_customer",)),
    "v_fct_reviews_secure": (security.reviews_secure, ("fct_reviews",)),
}
SILVER = tuple(name for name in BUILDERS if name.startswith("sv_"))
# Gold tables by stage: those of one stage only need earlier stages.
GOLD_STAGES = (
    ("dim_order_status", "dim_date", "dim_seller", "dim_product", "dim_customer",
     "bridge_customer_order"),
    ("fct_order_items", "fct_payments", "fct_reviews"),
    ("mart_delivery_performance", "mart_seller_scorecard", "mart_monthly_revenue"),
)
GOLD = tuple(name for stage in GOLD_STAGES for name in stage)


class Lake:
    """``Lake(spark, bronze)["mart_monthly_revenue"]`` is that table as a lazy frame.

    ``tables`` supplies any data set under its name, bronze or later: given frames (stored tables,
    for instance) are used as they are and only what is missing gets built.
    """

    def __init__(
        self,
        spark: SparkSession,
        tables: Mapping[str, DataFrame],
        calendar: tuple[str, str] = CALENDAR_RANGE,
        min_seller_lines: int = 20,
        fanout_safe: bool = False,
        newest_orders_only: bool = False,
    ):
        self.spark = spark
        self._tables = tables
        self._settings = {
            "calendar": calendar, "min_seller_lines": min_seller_lines, "fanout_safe": fanout_safe,
            "newest_orders_only": newest_orders_only,
        }
        self._built: dict[str, DataFrame] = {}
        self._registered = False
        self.calendar = calendar
        self.newest_orders_only = newest_orders_only
        self._options = {
            "mart_seller_scorecard": {"min_lines": min_seller_lines, "fanout_safe": fanout_safe},
            "mart_delivery_performance": {"fanout_safe": fanout_safe},
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            given = name in self._tables
            self._built[name] = self._tables[name] if given else self._build(name)
        return self._built[name]

    def with_tables(self, tables: Mapping[str, DataFrame]) -> Lake:
        """The same lake with more data sets given."""
        return Lake(self.spark, ChainMap(dict(tables), self._tables), **self._settings)

    def _build(self, name: str) -> DataFrame:
        if name == "dim_date":
            return gold.dim_date(self.spark, self.calendar)
        if name == "dim_order_status":
            return gold.dim_order_status(self.spark)
        build, inputs = BUILDERS[name]
        frame = build(*[self[i] for i in inputs], **self._options.get(name, {}))
        frame = drop_failing(frame, rules_for(name))
        if name == "sv_orders" and self.newest_orders_only:
            frame = silver.newest_orders(frame)
        return frame

    def before_rules(self, name: str) -> DataFrame:
        """The data set with the rows its drop rules would remove, for counting."""
        if name in self._tables or name not in BUILDERS:
            return self[name]
        build, inputs = BUILDERS[name]
        return build(*[self[i] for i in inputs], **self._options.get(name, {}))

    def register_views(self, names: Iterable[str] = (*SILVER, *GOLD)) -> None:
        """Expose data sets as temporary views for ``spark.sql``."""
        for name in names:
            self[name].createOrReplaceTempView(name)

    def sql(self, text: str) -> DataFrame:
        """Run SQL over the data sets by their plain names."""
        if not self._registered:
            self.register_views()
            self._registered = True
        return self.spark.sql(text)
