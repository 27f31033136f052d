"""Operations and card profiles in common buckets: same rows as the plain join, no Exchange for the bucketed part."""

from cardsentry import schemas
from cardsentry.operators.enrich import PROFILE_COLUMNS, TX_COLUMNS, card_profile, enrich
from cardsentry.sources.card_store import CardStore


def stored(spark, world, tx, tmp_path, name, buckets=4):
    store = CardStore(name, str(tmp_path))
    store.write(tx, card_profile(world.cards, world.accounts, world.clients), buckets)
    return store


def test_bucketed_join_plans_no_exchange_and_keeps_hot_cards_aside(spark, world, tmp_path):
    rows = [(str(i), f"2024-03-01 00:{i % 60:02d}:00", i, ("0001" if i % 3 else "0002") if i % 2 else f"00{10 + i % 5}"[-4:], "SUCCESS", "T1") for i in range(200)]
    tx = world.tx(rows + rows[:5] + [("n", "2024-03-01 00:00:00", 1, "9999", "SUCCESS", "T1")])
    nulls = spark.createDataFrame([("null", None, None, None, "pay", "SUCCESS", "T1")], schemas.TRANSACTIONS)
    tx = tx.unionByName(nulls)
    store = stored(spark, world, tx, tmp_path, "hot_case")
    assert 0 < spark.table(store.hot).where("card_num IS NOT NULL").select("card_num").distinct().count() < 4
    assert spark.table(store.hot).count() + spark.table(store.even).count() == tx.count()
    got = store.enriched(spark, TX_COLUMNS + PROFILE_COLUMNS)
    want = enrich(tx, world.cards, world.accounts, world.clients).select(*TX_COLUMNS, *PROFILE_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 50
    even = spark.table(store.even).join(spark.table(store.profiles).hint("merge"), "card_num")
    plan = even._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    whole = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in whole
    store.drop(spark)
    assert not spark.catalog.tableExists(store.even)


def test_empty_tables(spark, world, tmp_path):
    store = stored(spark, world, spark.createDataFrame([], schemas.TRANSACTIONS), tmp_path, "empty_case")
    assert store.enriched(spark, TX_COLUMNS + PROFILE_COLUMNS).collect() == []
