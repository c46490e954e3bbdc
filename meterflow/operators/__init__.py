from meterflow.operators.consumption import (
    above_average_consumers,
    above_average_sql,
    daily_average,
    daily_by_meter,
    daypart_profile,
    for_year,
    season_hour_profile,
    top_consumers,
    yearly_average,
    yearly_by_meter,
)
from meterflow.operators.enrich import enrich_city, hot_keys, lookup_join
from meterflow.operators.points import to_city_points, to_country_points, unpivot_fields
from meterflow.operators.quality import (
    detect_rollback,
    learn_bounds,
    month_profiles,
    out_of_learnt_profile,
    out_of_profile,
)
from meterflow.operators.reconcile import build_hourly_store, compact_latest, diff_aggregates, diff_streams, reconcile
from meterflow.operators.series import (
    city_hourly_bars,
    city_map_latest,
    city_series_today,
    country_hourly_bars,
    country_series_today,
    hourly_bars,
    last_per_series,
    recent,
    select_series,
    since_local_midnight,
)
from meterflow.operators.stateful import live_city_map, live_hourly_bars, map_now, rollback_stream
from meterflow.operators.windows import (
    flat_window,
    hourly_by_meter,
    total_by_city,
    total_consumption,
    windowed_sum,
    windowed_sum_sql,
    without_repeats,
)
