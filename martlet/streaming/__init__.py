from martlet.streaming.incremental import (  # noqa: F401
    append_new_keys,
    incremental_load,
    incremental_orders_load,
)
