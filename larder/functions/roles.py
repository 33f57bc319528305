"""Resolve column roles by name pattern.

Inputs arrive with inferred schemas and free-form names. After name
normalisation each role is found as the *first* column, in column order, whose
name matches the role's pattern. An explicit mapping always wins. A mandatory
role that cannot be found raises one error listing the available columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass


def _first(columns: Sequence[str], pred: Callable[[str], bool]) -> str | None:
    return next((c for c in columns if pred(c)), None)


def _require(value: str | None, role: str, columns: Sequence[str]) -> str:
    if value is None:
        raise ValueError(f"no column found for role {role!r}; columns are {list(columns)}")
    return value


# The name patterns that define each role.
#   transactions: quantity  -> name contains "quantity"
#                 type      -> name contains "type"
#                 date      -> name contains "date" or "time"
#                 product   -> name contains "product"
#   inventory:    product   -> name contains "product" (else the first column)
#                 stock     -> contains "stock" and "quantity", or is "stock_quantity"
#                              (else contains "quantity", else the second column)
#                 received  -> contains "received"
#                 last order-> contains "last_order" or "order_date"
#                 reorder   -> contains "reorder" and "level"
#   suppliers:    product   -> contains "product"
#                 lead time -> contains "lead_time" or "leadtime"
#                 id        -> contains "supplier" and "id"


@dataclass(frozen=True)
class TransactionRoles:
    product: str
    type: str
    quantity: str
    date: str


@dataclass(frozen=True)
class InventoryRoles:
    product: str
    stock: str
    date_received: str | None = None
    last_order: str | None = None
    reorder_level: str | None = None


@dataclass(frozen=True)
class SupplierRoles:
    product: str | None = None
    lead_time: str | None = None
    supplier_id: str | None = None


def resolve_transaction_roles(columns: Sequence[str], **explicit: str) -> TransactionRoles:
    cols = list(columns)
    found = {
        "quantity": _first(cols, lambda c: "quantity" in c),
        "type": _first(cols, lambda c: "type" in c),
        "date": _first(cols, lambda c: "date" in c or "time" in c),
        "product": _first(cols, lambda c: "product" in c),
    }
    found.update({k: v for k, v in explicit.items() if v is not None})
    return TransactionRoles(**{k: _require(v, f"transactions.{k}", cols) for k, v in found.items()})


def resolve_inventory_roles(columns: Sequence[str], **explicit: str | None) -> InventoryRoles:
    cols = list(columns)
    if not cols:
        raise ValueError("inventory has no columns")
    product = _first(cols, lambda c: "product" in c) or cols[0]
    stock = _first(cols, lambda c: ("stock" in c and "quantity" in c) or c == "stock_quantity")
    if stock is None:
        stock = _first(cols, lambda c: "quantity" in c)
    if stock is None:
        stock = _require(cols[1] if len(cols) > 1 else None, "inventory.stock", cols)
    found = {
        "product": product,
        "stock": stock,
        "date_received": _first(cols, lambda c: "received" in c),
        "last_order": _first(cols, lambda c: "last_order" in c or "order_date" in c),
        "reorder_level": _first(cols, lambda c: "reorder" in c and "level" in c),
    }
    found.update({k: v for k, v in explicit.items() if v is not None})
    return InventoryRoles(**found)


def resolve_supplier_roles(columns: Sequence[str], **explicit: str | None) -> SupplierRoles:
    cols = list(columns)
    found = {
        "product": _first(cols, lambda c: "product" in c),
        "lead_time": _first(cols, lambda c: "lead_time" in c or "leadtime" in c),
        "supplier_id": _first(cols, lambda c: "supplier" in c and "id" in c),
    }
    found.update({k: v for k, v in explicit.items() if v is not None})
    return SupplierRoles(**found)
