"""Enriched operations (J1-J3) and the point-in-time terminal city.

The reference writes the cards -> accounts -> clients chain six times; here
it is one dimension-level "card profile" (built at dimension scale), joined
once to the operations on ``card_num``. The passport blacklist is folded into
the profile as ``blocked_from = min(date)`` per passport, so the locked-
passport rule becomes a filter (t > any(date) <=> t > min(date)) and the
repeated blacklist rows cannot fan out the operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsentry.operators.sizing import broadcast_if_bounded, broadcast_if_small, broadcast_limit, join_in_shares, key_shares, size_bound

TX_COLUMNS = ["transaction_id", "transaction_date", "amount", "card_num", "oper_type",
              "oper_result", "terminal"]
PROFILE_COLUMNS = ["account", "valid_to", "client_id", "last_name", "first_name", "patronymic",
                   "passport_num", "passport_valid_to", "phone"]


def blocked_from(blacklist: DataFrame) -> DataFrame:
    """Earliest block date per passport (partial aggregation before the shuffle)."""
    return blacklist.groupBy("passport").agg(F.min("date").alias("blocked_from"))


def card_profile(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                 blacklist: DataFrame | None = None) -> DataFrame:
    """cards ⋈ accounts ⋈ clients (⟕ blocked_from): one row per card version chain."""
    acc = accounts.select("account", "valid_to", "client")
    cli = clients.select("client_id", "last_name", "first_name", "patronymic", "passport_num",
                         "passport_valid_to", "phone")
    # dimension joins: the smaller side is broadcast only behind its size check
    cli_in, cli = cli, broadcast_if_small(cli)
    acc_cli = acc.join(cli, acc["client"] == cli["client_id"]).drop("client")
    acc_cli = broadcast_if_bounded(acc_cli, [acc, cli_in], [("client_id", cli_in)])
    prof = cards.select("card_num", "account").join(acc_cli, "account")
    cols = ["card_num"] + PROFILE_COLUMNS
    if blacklist is not None:
        bl = broadcast_if_small(blocked_from(blacklist))
        prof = prof.join(bl, prof["passport_num"] == bl["passport"], "left").drop("passport")
        cols.append("blocked_from")
    return prof.select(*cols)


def enrich(transactions: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
           blacklist: DataFrame | None = None) -> DataFrame:
    """Operations with their account and client (inner joins, as in the reference).

    The profile is broadcast only when its inputs prove it below the
    session's broadcast limit (the join itself is not run for that); otherwise
    both sides shuffle on ``card_num`` and AQE splits a hot card's partition.
    """
    cards = cards.select("card_num", "account")
    acc = accounts.select("account", "valid_to", F.col("client").alias("_client"))
    cli = clients.select("client_id", "last_name", "first_name", "patronymic", "passport_num", "passport_valid_to", "phone")
    inputs = [cards, acc, cli, *([] if blacklist is None else [blacklist])]
    prof = broadcast_if_bounded(card_profile(cards, accounts, clients, blacklist), inputs, [("account", acc), ("client_id", cli)])
    tx = transactions.select(*TX_COLUMNS)
    out = tx.join(prof, "card_num")
    extra = ["blocked_from"] if blacklist is not None else []
    return out.select(*TX_COLUMNS, *PROFILE_COLUMNS, *extra)


NARROW_TX = ["transaction_id", "transaction_date", "amount", "oper_result", "terminal"]
NARROW_PROFILE = ["account", "valid_to", "client_id", "passport_valid_to"]
CLIENT_COLUMNS = ["last_name", "first_name", "patronymic", "passport_num", "phone"]


def enrich_narrow(transactions: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  blacklist: DataFrame | None = None) -> DataFrame:
    """Operations with what the rules compare, and the client's id; names and phone join to the hits
    (``attach_clients``). The card side is broadcast only if its inputs prove it small; no join is run to
    measure it.
    """
    cards = cards.select("card_num", "account")
    acc = accounts.select("account", "valid_to", F.col("client").alias("_client"))
    cli = clients.select("client_id", "passport_valid_to", "passport_num")
    inputs = [cards, acc, cli]
    prof = cards.join(broadcast_if_small(acc), "account")
    prof = prof.join(broadcast_if_small(cli), prof["_client"] == cli["client_id"]).drop("_client")
    if blacklist is not None:
        bl = blocked_from(blacklist)
        prof = prof.join(broadcast_if_small(bl), prof["passport_num"] == bl["passport"], "left").drop("passport")
        inputs.append(blacklist)
    prof = prof.drop("passport_num")
    small = broadcast_if_bounded(prof, inputs, [("account", acc), ("client_id", cli)])
    tx = transactions.select(*NARROW_TX, "card_num")
    if small is not prof or tx.isStreaming:
        out = tx.join(small, "card_num")
    else:  # a hot card in several tasks
        prof = prof.withColumnRenamed("card_num", "_card")
        out = join_in_shares(tx, prof, "card_num", "_card", key_shares(tx, "card_num"))
    return out.select(*NARROW_TX, *NARROW_PROFILE, *(["blocked_from"] if blacklist is not None else []))


def client_shares(operations: DataFrame, clients: DataFrame) -> DataFrame | None:
    """Shares of the clients with very many operations, for ``attach_clients`` of these operations' hits; None if there
    are none, or if the clients can be broadcast."""
    limit = broadcast_limit(clients)
    if limit >= 0 and size_bound(clients.select(F.col("client_id").alias("_id"), *CLIENT_COLUMNS))[1] <= limit:
        return None
    return key_shares(operations, "client_id")


def attach_clients(hits: DataFrame, clients: DataFrame, shares: DataFrame | None = None) -> DataFrame:
    """Hits with the client's report columns instead of the client's id; `shares` (``client_shares``): clients whose
    hits are joined by several tasks."""
    cli = broadcast_if_small(clients.select(F.col("client_id").alias("_id"), *CLIENT_COLUMNS))
    return join_in_shares(hits, cli, "client_id", "_id", shares).drop("_id", "client_id").withColumnRenamed("passport_num", "passport")


def with_city(events: DataFrame, terminals: DataFrame, point_in_time: bool = True,
              ts: str = "transaction_date", terminal: str = "terminal") -> DataFrame:
    """Attach ``terminal_city``.

    ``point_in_time``: the terminal version valid at the operation time
    (``effective_from <= ts < effective_to``); otherwise every version of the
    terminal (the reference's key-only join). Operations with an unknown or
    NULL terminal drop out (inner join).
    """
    has_validity = {"effective_from", "effective_to"} <= set(terminals.columns)
    t = terminals.select(F.col("terminal_id").alias("_tid"), "terminal_city",
                         *([F.col("effective_from").alias("_tfrom"), F.col("effective_to").alias("_tto")]
                           if has_validity else []))
    t = broadcast_if_small(t)
    cond = events[terminal] == t["_tid"]
    if point_in_time and has_validity:
        cond = cond & (events[ts] >= t["_tfrom"]) & (events[ts] < t["_tto"])
    return events.join(t, cond).drop("_tid", "_tfrom", "_tto")


def version_chunks(versions: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Terminal versions dealt to chunks of time that hold about `chunk` version starts each.

    Returns (terminal, starts): when each chunk of a terminal begins, rising; and (terminal, chunk, versions' columns):
    every version in each chunk that its validity meets. A chunk thus holds `chunk` versions and those still valid
    when it begins.
    """
    order = Window.partitionBy("_tid").orderBy("_tfrom", "_tto", "terminal_city")
    numbered = versions.withColumn("_n", F.row_number().over(order))
    starts = numbered.where((F.col("_n") - 1) % chunk == 0).groupBy("_tid").agg(F.array_sort(F.collect_set("_tfrom")).alias("_starts"))
    held = versions.join(starts, "_tid")
    last = F.greatest(chunk_of("_starts", "_tfrom"), chunk_of("_starts", "_tto", before=True))
    dealt = held.withColumn("_chunk", F.explode(F.sequence(chunk_of("_starts", "_tfrom"), last)))
    return starts, dealt.drop("_starts")


def chunk_of(starts: str, ts: str, before: bool = False) -> Column:
    """Number of chunks that begin at or before a time (`before`: before it)."""
    return F.size(F.filter(starts, lambda s: (s < F.col(ts)) if before else (s <= F.col(ts))))


def with_city_chunked(events: DataFrame, terminals: DataFrame, chunk: int = 32, ts: str = "transaction_date", terminal: str = "terminal") -> DataFrame:
    """``with_city`` at the operation time for terminals with very many versions: same rows.

    An operation first finds its chunk in its terminal's list of chunk starts (one row per terminal), then meets only
    the versions of that chunk, by an equi-join on (terminal, chunk). Neither join multiplies operations by versions,
    and a hot terminal's operations spread over its chunks in the second one.
    """
    t = terminals.select(F.col("terminal_id").alias("_tid"), "terminal_city", F.col("effective_from").alias("_tfrom"), F.col("effective_to").alias("_tto"))
    t = t.where("_tid IS NOT NULL AND _tfrom < _tto")
    starts, dealt = version_chunks(t, chunk)
    starts = broadcast_if_small(starts)
    placed = events.join(starts, events[terminal] == starts["_tid"]).withColumn("_at", chunk_of("_starts", ts)).drop("_tid", "_starts")
    dealt = broadcast_if_small(dealt)
    met = (placed[terminal] == dealt["_tid"]) & (placed["_at"] == dealt["_chunk"]) & (placed[ts] >= dealt["_tfrom"]) & (placed[ts] < dealt["_tto"])
    return placed.join(dealt, met).drop("_tid", "_tfrom", "_tto", "_chunk", "_at")
