"""Driver-side name rules (pure Python) and native column expressions."""

from shelfwise.functions.naming import (
    InventoryRoles,
    SupplierRoles,
    TransactionRoles,
    normalize_columns,
    normalize_name,
    normalized_names,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)
from shelfwise.functions.columns import (
    SALE_LABELS,
    is_sale,
    safe_date,
    safe_double,
    safe_timestamp,
)

__all__ = [
    "InventoryRoles", "SupplierRoles", "TransactionRoles",
    "normalize_columns", "normalize_name", "normalized_names",
    "resolve_inventory_roles", "resolve_supplier_roles", "resolve_transaction_roles",
    "SALE_LABELS", "is_sale", "safe_date", "safe_double", "safe_timestamp",
]
