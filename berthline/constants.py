"""Fixed values that must equal the surveyed pipeline's for equal results.

Fixed values: event codes, the column drop list, null fills, one-hot columns,
output projections, the null-token list of the CSV reader and history parameters.
"""

# Event type codes and pickup locations.
EVENT_PICKUP = "OGT"
EVENT_AVP = "AVP"
EVENT_HLP = "HLP"
EVENT_DFV = "DFV"
EVENT_LTV = "LTV"
PICKUP_LOCATIONS = ("STE1", "STE2")

# Columns dropped after the lookups, in the surveyed order.
DROP_COLUMNS = (
    "check_digit", "event_record_type_code", "booking_number_y",
    "priority_stow_code", "vessel_code_y", "voyage_y", "direction_seq_y",
    "equipment_id_y", "empty_full_code_y", "equipment_voyage", "equipment_direction_seq",
    "load_port_code_y", "discharge_port_code_y", "destination_port_code_y",
    "previous_load_port_code", "previous_load_vessel_code", "mounted_to_equipment_id",
    "life_cycle_status", "current_direction_seq", "actual_temperature",
    "actual_temperature_scale", "ingate_trucker_code", "create_user",
    "create_date", "last_update_user", "last_update_date", "auto_cfs_code",
    "b_p_bol_origin_port_code", "b_p_bol_destination_port_code",
)

# Columns parsed as datetimes (missing ones are skipped).
DATE_COLUMNS = ("event_date", "sail_date", "stow_date", "ingate_date",
                "create_date", "last_update_date", "arrival_time")

# Durations that must be non-negative.
NON_NEGATIVE_COLUMNS = ("port_to_ste_time", "arrival_to_pickup_time", "time_to_unload",
                        "time_til_avp", "storage_time")

# Columns that must be present.
REQUIRED_COLUMNS = ("consignee_name", "shipper_name", "booking_number",
                    "storage_time", "arrival_time", "carrier_code")

# Null fills, in order; the two misspelt fills are data and kept as is.
NULL_FILLS = (
    ("hazard_type_code", "Unknown"),
    ("current_damage_code", "Unknown"),
    ("equipment_type_height_code", "Unkown"),
    ("commodity", "Unkown"),
    ("life_cycle_status_code", "Unknown"),
    ("pds_code", "Unknown"),
    ("discharge_port_code", "Unknown"),
)

# One-hot encoded columns.
ONE_HOT_COLUMNS = ("empty_full_code", "trade_route", "pds_code", "plan_equip_type_code")

# One-day pickup threshold in hours.
ONE_DAY_HOURS = 24

# Scored output projections (batch file, request).
SCORED_COLUMNS = ("equipment_id", "booking_number", "consignee_name", "voyage_code",
                  "stowage_priority")
REQUEST_COLUMNS = ("equipment_id", "consignee_name", "voyage_code", "stowage_priority")

# Text tokens the CSV reader turns into null (pandas defaults).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# History feature parameters.
LOW_HISTORY_BELOW = 5
RECENT_WINDOWS = (5, 10)
RATE_WINDOW = 5
DECAY = 0.9
SENTINEL = -1.0
WEEKEND_DAYS = (5, 6)

# Text of null key parts (string/float parts, nullable-int parts).
NULL_TEXT = "nan"
NULL_INT_TEXT = "<NA>"

# Consignee encoder defaults.
RARE_THRESHOLD = 3
CONSIGNEE_PRIOR_WEIGHT = 5
TARGET_ENCODE_ALPHA = 10
