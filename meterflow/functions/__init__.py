from meterflow.functions.bands import daypart, season, season_factor
from meterflow.functions.clock import (
    calendar_parts,
    epoch_to_timestamp,
    local_date,
    local_hour,
    local_midnight,
    time_shift,
    unix_window,
)
from meterflow.functions.columns import drop_columns, rename_by_regex
from meterflow.functions.messages import encode_json, message_key, parse_messages
