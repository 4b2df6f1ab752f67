from buycast.sources.bucketed import attach_bucketed, read_families, write_bucketed
from buycast.sources.files import (
    load_model, read_codes, read_customers, read_features, read_logs, read_order_detail, rejected_lines, save_model,
    write_candidates, write_codes, write_csv, write_features,
)
from buycast.sources.star import events_as_orders, order_detail

__all__ = [
    "attach_bucketed", "events_as_orders", "load_model", "order_detail", "read_codes", "read_customers", "read_features",
    "read_logs", "read_families", "read_order_detail", "save_model", "write_bucketed", "write_candidates", "write_codes", "write_csv",
    "write_features",
]
