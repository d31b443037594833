from contrail.operators.aggregate import (  # noqa: F401
    altitude_band_counts, country_window_agg, equal_width_histogram, value_counts,
)
from contrail.operators.enrich import (  # noqa: F401
    broadcast_bound_ok, measured_size, enrich, fan_out_by_dimension, join_strategy, rapid_descent,
    salted_left_join, with_event_time,
)
from contrail.operators.rank import key_ordered_scan, latest_by_key, top_k  # noqa: F401
