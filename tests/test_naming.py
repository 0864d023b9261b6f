import pytest
from hypothesis import given
from hypothesis import strategies as st

from shelfwise.functions.naming import (
    normalize_name,
    normalized_names,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)


@pytest.mark.parametrize("raw,each,collapse", [
    (" Unit Price", "unit_price", "unit_price"),
    ("a--b", "a__b", "a_b"),
    ("A/B", "a_b", "a_b"),
    ("a  b", "a__b", "a_b"),
    ("Stock-Quantity", "stock_quantity", "stock_quantity"),
    ("Last/Order Date", "last_order_date", "last_order_date"),
])
def test_normalize_rules(raw, each, collapse):
    assert normalize_name(raw) == each
    assert normalize_name(raw, collapse=True) == collapse


def test_collisions_get_suffixes():
    assert normalized_names(["a  b", "a--b", "A B"], collapse=True) == ["a_b", "a_b_2", "a_b_3"]
    assert normalized_names(["Unit Price", "Unit-Price"]) == ["unit_price", "unit_price_2"]


names = st.lists(st.text(alphabet="ab -/_\tXY", min_size=1, max_size=8), min_size=1, max_size=6)


@given(names, st.booleans())
def test_normalize_idempotent_and_unique(cols, collapse):
    once = normalized_names(cols, collapse)
    assert len(set(once)) == len(once)
    if collapse:
        assert normalized_names(once, collapse) == once


def test_transaction_roles():
    r = resolve_transaction_roles(["id", "product_id", "transaction_type", "quantity_change",
                                   "transaction_date"])
    assert (r.product, r.type, r.quantity, r.date) == (
        "product_id", "transaction_type", "quantity_change", "transaction_date")


def test_transaction_roles_missing_fails_early():
    with pytest.raises(ValueError, match="role"):
        resolve_transaction_roles(["product_id", "quantity"])


def test_first_match_trap_and_override():
    cols = ["product_name", "product_id", "stock_quantity"]
    assert resolve_inventory_roles(cols).product == "product_name"
    assert resolve_inventory_roles(cols, {"product": "product_id"}).product == "product_id"
    with pytest.raises(ValueError):
        resolve_inventory_roles(cols, {"product": "nope"})


def test_inventory_fallbacks():
    r = resolve_inventory_roles(["sku", "qty_on_hand", "reorder_level"])
    assert r.product == "sku" and r.stock == "qty_on_hand" and r.reorder_level == "reorder_level"
    r = resolve_inventory_roles(["sku", "x", "quantity"])
    assert r.stock == "quantity"
    r = resolve_inventory_roles(["product_id", "stock_quantity", "date_received", "last_order_date"])
    assert (r.received, r.last_order, r.reorder_level) == ("date_received", "last_order_date", None)


def test_supplier_roles():
    r = resolve_supplier_roles(["supplier_id", "product_id", "average_lead_time_days"])
    assert (r.product, r.lead_time, r.supplier_id) == ("product_id", "average_lead_time_days", "supplier_id")
    r = resolve_supplier_roles(["supplier_id", "leadtime"])
    assert r.product is None and r.lead_time == "leadtime"
