"""Parameters with their defaults. Dates are inclusive ISO dates."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RecParams:
    # windows
    event_start: str = "2025-09-01"
    event_end: str = "2026-02-01"
    pop_start: str = "2024-01-01"
    pop_end: str = "2025-08-31"
    excl_start: str = "2025-02-01"
    excl_end: str = "2026-02-01"
    min_year: int = 2024
    max_year: int = 2026
    # eligibility
    min_price: float = 50.0
    allow_price_fallback: bool = True
    min_parts_per_vehicle: int = 4
    # popularity
    segment_weight: float = 10.0
    make_weight: float = 8.0
    global_weight: float = 2.0
    min_segment_orders: int = 2
    min_make_orders: int = 2
    min_segment_for_use: int = 5
    min_make_for_use: int = 20
    normalize_both: bool = False
    require_purchase_signal: bool = False
    # intent
    order_weight: float = 20.0
    cart_weight: float = 10.0
    view_weight: float = 2.0
    # ranking
    max_per_category: int = 2
    slots: int = 4
    pool_size: int = 500
    min_recs: int = 3
    version: str = "v1"

    def but(self, **changes) -> "RecParams":
        return replace(self, **changes)


#: windows and floors that suit the test tables (orders 1995-2001, events January 2024); the
#: exclusion window cuts both the imported orders and the events
TEST_PARAMS = RecParams(
    event_start="2024-01-01", event_end="2024-01-31",
    pop_start="1995-01-01", pop_end="2000-12-31",
    excl_start="2000-08-01", excl_end="2024-01-20",
    min_year=1995, max_year=2024, min_price=905.0, normalize_both=True,
)
