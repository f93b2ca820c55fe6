from martlet.functions.labels import (  # noqa: F401
    ALL_PAYMENT_LABELS,
    OTHER_PAYMENT,
    PAYMENT_LABELS,
    UNKNOWN_CATEGORY,
    payment_label,
)
from martlet.functions.money import (  # noqa: F401
    as_double,
    cents,
    cents_sum,
    from_cents,
    money,
    money_sum,
)
from martlet.functions.timekeys import (  # noqa: F401
    add_minutes,
    blank_to_null,
    format_time,
    minute_floor,
    minute_key,
    minute_key_of,
    parse_time_lenient,
    parse_time_strict,
    try_minute_key,
    weekday_name,
    year_quarter,
)
