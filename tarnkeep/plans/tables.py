"""Contracts of the tables the jobs read."""

from __future__ import annotations

from dataclasses import dataclass

from tarnkeep.operators.contracts import Contract

# Column names and types of the order, sales and promotion files.
ORDERS = Contract({
    "order_id": "STRING",
    "customer_id": "STRING",
    "customer_name": "STRING",
    "email": "STRING",
    "region": "STRING",
    "order_date": "DATE",
    "product_category": "STRING",
    "product_name": "STRING",
    "quantity": "INT",
    "unit_price": "DECIMAL(10,2)",
    "discount_pct": "INT",
    "total_amount": "DECIMAL(10,2)",
    "sales_channel": "STRING",
    "payment_method": "STRING",
    "order_status": "STRING",
    "ship_date": "DATE",
    "shipping_zip": "STRING",
})

SALES = Contract({
    "transaction_id": "BIGINT",
    "line_number": "INT",
    "transaction_date": "DATE",
    "store_id": "BIGINT",
    "sku": "BIGINT",
    "customer_id": "BIGINT",
    "promotion_id": "BIGINT",
    "quantity_sold": "INT",
})

PROMOTIONS = Contract({
    "promotion_id": "BIGINT",
    "promotion_name": "STRING",
    "promotion_type": "STRING",
    "discount_pct": "DOUBLE",
    "start_date": "DATE",
    "end_date": "DATE",
})

# The columns that identify an order line.
ORDER_DEDUP_KEYS = ("order_id", "customer_id", "order_date", "product_name")


@dataclass(frozen=True)
class HistorySpec:
    """A history table: the contract of its input and the key of its rows."""

    contract: Contract
    keys: tuple[str, ...]

    @property
    def tracked(self) -> list[str]:
        return [c for c in self.contract.names if c not in self.keys]


SALES_HISTORY = HistorySpec(SALES, ("transaction_id", "line_number"))
PROMOTION_HISTORY = HistorySpec(PROMOTIONS, ("promotion_id",))
