"""Column-expression helpers (all built-in Spark SQL functions, no UDFs)."""

from ledgerline.functions.money import (  # noqa: F401
    as_double, pct, ratio,
)
from ledgerline.functions.predicates import (  # noqa: F401
    is_high_discount, is_loss, is_profitable, is_zero_discount, scatter_sign,
    table_sign,
)
from ledgerline.functions.formats import (  # noqa: F401
    currency_label, percent_label, thousands_label,
)
