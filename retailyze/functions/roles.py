"""Column-role detection by name (schema only, no data is read)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

# The ordered name patterns per role. For each role the patterns
# are tried in this order; the first column (in column order) whose lower-cased
# name contains the pattern wins. Quantity skips names containing 'sales'.
ROLE_PATTERNS: dict[str, list[str]] = {
    "sales": ["sales", "revenue", "amount", "total", "value", "price"],
    "profit": ["profit", "margin", "earnings", "income"],
    "category": ["category", "type", "class", "group", "segment", "product_category"],
    "customer": ["customer", "client", "user", "buyer", "customer_name", "customer_id"],
    "date": ["date", "time", "order_date", "purchase_date", "transaction_date"],
    "region": ["region", "state", "country", "location", "area", "city"],
    "quantity": ["quantity", "qty", "amount", "count", "units"],
    "product": ["product", "item", "sku", "product_name", "product_id"],
}
ROLE_EXCLUDES: dict[str, str] = {"quantity": "sales"}


def detect_roles_from_names(columns: Sequence[str],
                            overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    # a later column with the same lower-cased name replaces an earlier one
    lower: dict[str, str] = {}
    for c in columns:
        lower[c.lower()] = c
    roles: dict[str, str] = {}
    for role, patterns in ROLE_PATTERNS.items():
        excl = ROLE_EXCLUDES.get(role)
        for pat in patterns:
            hits = [orig for low, orig in lower.items()
                    if pat in low and (excl is None or excl not in low)]
            if hits:
                roles[role] = hits[0]
                break
    for role, c in (overrides or {}).items():
        if c not in columns:
            raise KeyError(f"override for {role!r}: no column {c!r}")
        roles[role] = c
    return roles


def detect_roles(df: DataFrame, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Role -> column name for sales, profit, category, customer, date,
    region, quantity and product."""
    return detect_roles_from_names(df.columns, overrides)
