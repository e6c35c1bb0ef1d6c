"""Business rules of a single event, as one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.schemas import GUEST_USER, PAGE_VIEW

UNREADABLE_TIMESTAMP = "unreadable_timestamp"
MISSING_PRODUCT = "missing_product"
UNKNOWN_PRODUCT = "unknown_product"
UNKNOWN_USER = "unknown_user"


def reject_reason(
    event_type: Column,
    product_id: Column,
    product_unknown: Column,
    user_id: Column,
    user_unknown: Column,
    timestamp_unreadable: Column,
) -> Column:
    """First rule the event breaks, null for a good event.

    * Every event but a page view names a product of the catalogue. An event without a type is not
      held to this rule.
    * Every user but the guest is a registered user.
    """
    needs_product = event_type != PAGE_VIEW
    return (
        F.when(timestamp_unreadable, UNREADABLE_TIMESTAMP)
        .when(needs_product & product_id.isNull(), MISSING_PRODUCT)
        .when(needs_product & product_unknown, UNKNOWN_PRODUCT)
        .when((user_id != GUEST_USER) & user_unknown, UNKNOWN_USER)
    )
