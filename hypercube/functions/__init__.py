"""Column expressions; all built-in Spark functions, no Python UDFs."""

from hypercube.functions.geometry import mean_z, polygon_area, rectangle
from hypercube.functions.names import (normalize_columns, normalize_name,
                                       normalize_name_table, zone_from_header,
                                       zone_label)
from hypercube.functions.numeric import (ach_to_flow, ceil_div, is_missing, joules_to_kwh,
                                         round_even)
from hypercube.functions.schedules import (availability_schedule, editable_layers, layer_list,
                                           setpoint_schedule, shading_schedule,
                                           shading_schedule_symmetric)
from hypercube.functions.timefmt import (heating_switch_times, hhmm, hour24_timestamp,
                                         shading_window_from_close,
                                         shading_window_symmetric)

__all__ = [
    "ach_to_flow", "availability_schedule", "ceil_div", "editable_layers",
    "heating_switch_times", "hhmm", "hour24_timestamp", "is_missing", "joules_to_kwh",
    "layer_list", "mean_z", "normalize_columns", "normalize_name", 
    "normalize_name_table", "polygon_area", "rectangle", "round_even",
    "setpoint_schedule", "shading_schedule", "shading_schedule_symmetric",
    "shading_window_from_close", "shading_window_symmetric", "zone_from_header", "zone_label",
]
