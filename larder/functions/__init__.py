from larder.functions.columns import (  # noqa: F401
    content_hash,
    normalize_name,
    normalized_names,
    null_if_nan,
    to_day,
    to_double,
    to_timestamp_lenient,
)
from larder.functions.roles import (  # noqa: F401
    InventoryRoles,
    SupplierRoles,
    TransactionRoles,
    resolve_inventory_roles,
    resolve_supplier_roles,
    resolve_transaction_roles,
)
