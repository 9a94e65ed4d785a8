"""Column roles and model settings as plain frozen dataclasses; the numbers and names are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RecColumns:
    user: str = "user_id"
    item: str = "item_id"
    timestamp: str = "timestamp"
    rating: str = "rating"
    interaction: str = "interaction_type"
    target: str = "signal"
    # explicit file-order columns used wherever results depend on row order
    order_cols: tuple[str, ...] = ()


@dataclass(frozen=True)
class RecModel:
    top_k_neighbors: int = 20
    item_blend: float = 0.65
    user_blend: float = 0.35


#: columns a transactions table must have
FRAUD_REQUIRED = ("transaction_id", "user_id", "transaction_amount", "transaction_time", "location", "device",
                  "merchant_category", "payment_channel", "is_international", "card_present",
                  "previous_transactions_24h", "avg_spend_7d", "label")
