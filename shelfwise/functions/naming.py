"""Column-name normalization and column-role discovery.

Both run on the driver over ``df.columns`` only: they never launch a job.
Roles are found by substring on the normalized names, the first match in
column order wins; explicit overrides always win over the rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

# Silver: each single space, '-' or '/' becomes '_'.
_EACH = re.compile(r"[ \-/]")
# Gold: a run of whitespace, '-' or '/' becomes one '_'.
_RUN = re.compile(r"[\s\-/]+")


def normalize_name(name: str, collapse: bool = False) -> str:
    """strip -> lower -> separators to '_' (one by one, or runs when ``collapse``)."""
    n = name.strip().lower()
    return _RUN.sub("_", n) if collapse else _EACH.sub("_", n)


def normalized_names(names: list[str], collapse: bool = False) -> list[str]:
    """Normalize a list of names; later duplicates get ``_2``, ``_3``, ..."""
    out: list[str] = []
    taken: set[str] = set()
    for name in names:
        base = normalize_name(name, collapse)
        cand, k = base, 2
        while cand in taken:
            cand, k = f"{base}_{k}", k + 1
        taken.add(cand)
        out.append(cand)
    return out


def normalize_columns(df: DataFrame, collapse: bool = False) -> DataFrame:
    """Rename all columns in one projection (C1 when ``collapse=False``, C2 otherwise)."""
    return df.toDF(*normalized_names(df.columns, collapse))


# How each column role is found. A role matches the first
# column (in column order) that contains every substring of one of its
# alternatives.
TRANSACTION_ROLE_RULES = {
    "product": (("product",),),
    "type": (("type",),),
    "quantity": (("quantity",),),
    "date": (("date",), ("time",)),
}
INVENTORY_ROLE_RULES = {
    "product": (("product",),),
    "stock": (("stock", "quantity"),),
    "received": (("received",),),
    "last_order": (("last_order",), ("order_date",)),
    "reorder_level": (("reorder", "level"),),
}
INVENTORY_STOCK_FALLBACK = (("quantity",),)  # then the second column
SUPPLIER_ROLE_RULES = {
    "product": (("product",),),
    "lead_time": (("lead_time",), ("leadtime",)),
    "supplier_id": (("supplier", "id"),),
}


def _matches(column: str, alternatives) -> bool:
    return any(all(part in column for part in alt) for alt in alternatives)


def _first(columns, alternatives, default=None):
    return next((c for c in columns if _matches(c, alternatives)), default)


def _apply_overrides(roles, overrides: dict | None, columns: list[str]):
    if not overrides:
        return roles
    known = {f.name for f in fields(roles)}
    for key, value in overrides.items():
        if key not in known:
            raise ValueError(f"unknown role {key!r}; expected one of {sorted(known)}")
        if value is not None and value not in columns:
            raise ValueError(f"override {key}={value!r} is not a column of {columns}")
        object.__setattr__(roles, key, value)
    return roles


def _require(roles, names: tuple[str, ...], columns: list[str], table: str):
    missing = [n for n in names if getattr(roles, n) is None]
    if missing:
        raise ValueError(f"{table}: no column found for role(s) {missing} among {columns}; "
                         f"pass overrides={{...}}")


@dataclass(frozen=True)
class TransactionRoles:
    product: str | None
    type: str | None
    quantity: str | None
    date: str | None


@dataclass(frozen=True)
class InventoryRoles:
    product: str
    stock: str
    received: str | None
    last_order: str | None
    reorder_level: str | None


@dataclass(frozen=True)
class SupplierRoles:
    product: str | None
    lead_time: str | None
    supplier_id: str | None


def resolve_transaction_roles(columns: list[str], overrides: dict | None = None) -> TransactionRoles:
    rules = TRANSACTION_ROLE_RULES
    roles = TransactionRoles(**{role: _first(columns, rules[role]) for role in rules})
    roles = _apply_overrides(roles, overrides, columns)
    _require(roles, ("product", "type", "quantity", "date"), columns, "transactions")
    return roles


def resolve_inventory_roles(columns: list[str], overrides: dict | None = None) -> InventoryRoles:
    """Product falls back to the first column; stock to the first column
    containing "quantity", else the second column."""
    if len(columns) < 2:
        raise ValueError(f"inventory needs at least two columns, got {columns}")
    rules = INVENTORY_ROLE_RULES
    found = {role: _first(columns, rules[role]) for role in rules}
    if found["product"] is None:
        found["product"] = columns[0]
    if found["stock"] is None:
        found["stock"] = _first(columns, INVENTORY_STOCK_FALLBACK, columns[1])
    return _apply_overrides(InventoryRoles(**found), overrides, columns)


def resolve_supplier_roles(columns: list[str], overrides: dict | None = None) -> SupplierRoles:
    rules = SUPPLIER_ROLE_RULES
    roles = SupplierRoles(**{role: _first(columns, rules[role]) for role in rules})
    return _apply_overrides(roles, overrides, columns)
