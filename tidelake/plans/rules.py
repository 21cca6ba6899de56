"""The expectations of every data set, put together from the rule operators, and what sends an order into quarantine."""

from __future__ import annotations

from tidelake.contracts import ORDER_STATUSES
from tidelake.operators.rules import (
    above, all_of, at_least, before, declare, differs, equals, identified, in_order_if_known, missing, one_of, present, unless, within,
)

DELIVERED = equals("order_status", "delivered")
NOT_DELIVERED = differs("order_status", "delivered")
ARRIVED = "order_delivered_customer_date"
SCORE = {"score_in_range": within("review_score", 1, 5)}

QUALITY_RULES = {
    "sv_orders": declare(
        drop=identified(valid_order_id="order_id", valid_customer_id="customer_id") | {"known_status": one_of("order_status", ORDER_STATUSES)},
        warn={
            "delivery_after_purchase": unless(missing(ARRIVED), f"{ARRIVED} >= order_purchase_timestamp"),
            "carrier_after_approval": in_order_if_known("order_approved_at", "order_delivered_carrier_date"),
            "delivered_has_date": unless(NOT_DELIVERED, present(ARRIVED)),
        },
    ),
    "sv_order_items": declare(
        drop=identified(valid_order_id="order_id", valid_item_seq="order_item_id"),
        warn={f"non_negative_{kind}": at_least(column, 0) for kind, column in (("price", "price"), ("freight", "freight_value"))},
    ),
    "sv_payments": declare(
        drop=identified(valid_order_id="order_id"),
        warn={"known_payment_type": differs("payment_type", "not_defined"), "positive_value": above("payment_value", 0)},
    ),
    "sv_reviews": declare(drop=identified(valid_review_id="review_id", valid_order_id="order_id"), warn=SCORE),
    "sv_customer_keys": declare(drop=identified(valid_customer_id="customer_id", valid_unique_id="customer_unique_id")),
    "dim_seller": declare(fail=identified(unique_seller="seller_id")),
    "dim_product": declare(fail=identified(unique_product="product_id"), warn=identified(category_resolved="category_en")),
    "dim_customer": declare(fail=identified(unique_person="customer_unique_id")),
    "fct_order_items": declare(
        fail=identified(valid_sk="order_item_sk"),
        warn=identified(has_customer_sk="customer_sk") | {"non_negative_revenue": at_least("gross_revenue", 0)},
    ),
    "fct_payments": declare(fail=identified(valid_sk="payment_sk")),
    "fct_reviews": declare(fail=identified(valid_sk="review_sk"), warn=SCORE),
}
# The first that holds names the reason.
QUARANTINE_REASONS = (
    ("carrier_before_approval", before("order_delivered_carrier_date", "order_approved_at")),
    ("delivered_before_purchase", before(ARRIVED, "order_purchase_timestamp")),
    ("delivered_without_date", all_of(DELIVERED, missing(ARRIVED))),
    ("undelivered_with_date", all_of(NOT_DELIVERED, present(ARRIVED))),
)
