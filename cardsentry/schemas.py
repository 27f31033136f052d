"""Target schemas of the stored tables."""

from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()

# Raw line fields of a transactions_DDMMYYYY.txt drop, by position.
TRANSACTION_FIELDS = ["transaction_id", "transaction_date", "amount", "card_num",
                      "oper_type", "oper_result", "terminal"]

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", S), T.StructField("transaction_date", TS),
    T.StructField("amount", T.DecimalType(18, 2)), T.StructField("card_num", S),
    T.StructField("oper_type", S), T.StructField("oper_result", S), T.StructField("terminal", S),
])

CARDS = T.StructType([T.StructField("card_num", S), T.StructField("account", S)])

# Client ids are text: seed values such as 'VIP-1' are not integers.
ACCOUNTS = T.StructType([T.StructField("account", S), T.StructField("valid_to", D),
                         T.StructField("client", S)])

CLIENTS = T.StructType([
    T.StructField("client_id", S), T.StructField("last_name", S), T.StructField("first_name", S),
    T.StructField("patronymic", S), T.StructField("passport_num", S),
    T.StructField("passport_valid_to", D), T.StructField("phone", S),
])

BLACKLIST = T.StructType([T.StructField("date", D), T.StructField("passport", S)])

# Terminal versions: half-open validity [effective_from, effective_to).
TERMINALS = T.StructType([
    T.StructField("terminal_id", S), T.StructField("terminal_city", S),
    T.StructField("effective_from", TS), T.StructField("effective_to", TS),
])

VALIDITY = ["effective_from", "effective_to", "deleted_flg"]

_STAMP = [T.StructField("effective_from", TS), T.StructField("effective_to", TS), T.StructField("deleted_flg", T.IntegerType())]
_SOURCE = [T.StructField("load_date", D), T.StructField("src_file", S)]

# Stored tables, with validity and the file that a row came from.
LOADED = T.StructType([*TRANSACTIONS.fields, *_STAMP, *_SOURCE])
_EXTRA = T.StructField("extra", T.MapType(S, S))
LOADED_BLACKLIST = T.StructType([*BLACKLIST.fields, _EXTRA, *_STAMP, *_SOURCE])
SNAPSHOTS = T.StructType([T.StructField("terminal_id", S), T.StructField("terminal_city", S), _EXTRA, *_STAMP, *_SOURCE])
SHEET_QUARANTINE = T.StructType([
    T.StructField("sheet", S), T.StructField("row_no", T.IntegerType()), T.StructField("cells", T.MapType(S, S)),
    T.StructField("reason", S), *_SOURCE])
VERSIONS = T.StructType([*TERMINALS.fields, T.StructField("deleted_flg", T.IntegerType())])

# Seed tables as the reference ships them, then stamped.
_DATES = [T.StructField("create_dt", D), T.StructField("update_dt", D)]
SEED = {
    "cards": T.StructType([*CARDS.fields, *_DATES]),
    "accounts": T.StructType([*ACCOUNTS.fields, *_DATES]),
    "clients": T.StructType([*CLIENTS.fields[:4], T.StructField("date_of_birth", D), *CLIENTS.fields[4:], *_DATES]),
}
SEED_STORED = {name: T.StructType([*schema.fields, *_STAMP]) for name, schema in SEED.items()}

# Report mart row (one schema for all five detections).
REPORT_COLUMNS = ["event_dt", "passport", "last_name", "first_name", "patronymic", "phone",
                  "event_type", "report_dt"]
MART = T.StructType([
    T.StructField("event_dt", TS), T.StructField("passport", S), T.StructField("last_name", S),
    T.StructField("first_name", S), T.StructField("patronymic", S), T.StructField("phone", S),
    T.StructField("event_type", S), T.StructField("report_dt", TS), T.StructField("report_date", D),
])

QUARANTINE = T.StructType([
    T.StructField("line", S), T.StructField("transaction_id", S), T.StructField("n_fields", T.IntegerType()),
    T.StructField("reason", S), T.StructField("business_date", D), T.StructField("src_file", S),
])
