"""Fixed values.

These literals must equal the reference's output exactly (event_type strings
of the report mart) or its input conventions (the successful result value).
"""

# --- fixed values: report event types, in rule order ---------------------
EVENT_LOCKED = "locked passport"
EVENT_OVERDUE = "overdue passport"
EVENT_CONTRACT = "invalid_contract"
EVENT_CITIES = "different cities within one hour"
EVENT_PROBING = "attempt_to_select_the_amount"

# --- fixed values: operation results ---------------------------------------
RESULT_SUCCESS = "SUCCESS"
# The rejected value never appears in the reference; it is a parameter with this default.
RESULT_REJECT = "REJECT"

# Open end of a current dimension version (half-open validity intervals).
OPEN_END = "9999-12-31 00:00:00"
