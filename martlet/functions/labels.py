"""Label mappings used by the order fact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment code -> report label. Any other code, NULL included,
# is labelled OTHER_PAYMENT.
PAYMENT_LABELS = {
    "boleto": "Bank Transfer",
    "credit_card": "Credit Card",
    "debit_card": "Debit Card",
}
OTHER_PAYMENT = "Other"
PAYMENT_LABEL_SEPARATOR = ", "

# Every label the mapping can produce, in sort order. The order fact lists the
# distinct labels of an order joined by the separator in this order.
ALL_PAYMENT_LABELS = sorted([*PAYMENT_LABELS.values(), OTHER_PAYMENT])

# Fixed value: the name a blank or missing product category gets.
UNKNOWN_CATEGORY = "Unknown"


def payment_label(code: Column | str) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for raw, label in PAYMENT_LABELS.items():
        expr = (F.when(c == raw, F.lit(label)) if expr is None
                else expr.when(c == raw, F.lit(label)))
    return expr.otherwise(F.lit(OTHER_PAYMENT))
