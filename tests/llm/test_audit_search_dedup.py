"""Reversed lexical search, filter audit and near duplicates: brute force, planted and edge cases; all queries with SQL."""

import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from cardsentry.llm import filter_audit, lexical_search, near_dedup, sql
from tools.compare import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(sql.ORACLES))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    columns, expected = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns) and rows
    assert digest(rows, df.columns) == digest(expected, columns)


# --------------------------------------------------------------- op11 ----

def brute_search(docs, items, k):
    """(item_id, rank, doc_id, score) by plain loops over (doc_id, text) and (item_id, text)."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    found = [(i, Counter(terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(c.total() for _, c in found)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = terms(text), []
        for i, c in found:
            m = 25 + 75 * c.total() * n_docs // total
            score = 0
            for term in asked:
                df = sum(term in other for _, other in found)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (minus, bare, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if bare else i, -minus))
    return out


def words_of(rng, n, most=40):
    return " ".join(rng.choice(["Abc", "ÄB", "x-y", "naïve", "z9"]) if rng.random() < 0.1 else f"w{rng.randrange(most)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    docs = [(i, words_of(rng, rng.randint(0, 60))) for i in range(70)]
    docs += [(100 + i, docs[3][1]) for i in range(25)]  # ties beyond k
    docs += [(None, docs[5][1]), (200, None), (201, ""), (202, "?! --"), (7, docs[7][1]), (203, "w1 " * 3000)]
    items = [(i, words_of(rng, rng.randint(1, 12))) for i in range(12)]
    items += [(0, items[0][1]), (1, "w3 w3 w3 w5"), (50, docs[3][1]), (51, None), (52, "..."), (53, "nowhere"), (None, "w9 w8")]
    return docs, items


@pytest.mark.parametrize("block", [4 << 20, 1000])
def test_search_matches_brute_force(spark, monkeypatch, corpus, block):
    docs, items = corpus
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", block)
    table = spark.createDataFrame([(i, t, 1, b"x") for i, t in docs], "doc_id long, text string, rank int, item_id binary").repartition(5)
    asked = spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, score double")
    got = [tuple(r) for r in lexical_search.search(table, asked, 4).collect()]
    assert Counter(got) == Counter(brute_search(docs, items, 4))


def test_search_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.search(docs, items).collect()] == brute_search([(1, "a b")], [(1, "a")], 10)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = ("Wörd one, two;THREE " * 500).encode()
    whole = lexical_search.count_terms(text)
    pair = filter_audit.word_counts(text)
    monkeypatch.setattr(lexical_search, "_CHUNK", 37)
    monkeypatch.setattr(filter_audit, "_CHUNK", 37)
    assert lexical_search.count_terms(text) == whole == Counter({b"w\xc3\xb6rd": 500, b"one": 500, b"two": 500, b"three": 500})
    assert filter_audit.word_counts(text) == pair == (1500, 3)
    assert lexical_search.count_terms(b"x" * 1000) == {b"x" * 1000: 1}


# --------------------------------------------------------------- op12 ----

def brute_audit(docs, labels):
    """Rows of the audit by applying every order document by document: docs (id, text, part), labels (id, quality, toxic)."""
    texts = [(i, t or "", p or "") for i, t, p in docs]

    def fails(i, t):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        copy = i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)
        return {f for f, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                                              100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), copy)) if bad}

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    marked = [(i, p, fails(i, t)) for i, t, p in texts]
    out = []
    for part in {p for _, p, _ in marked}:
        rows, shapley = [(i, f) for i, p, f in marked if p == part], Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, one in enumerate(order, 1):
                removed = [(i, f) for i, f in left if one in f]
                left = [(i, f) for i, f in left if one not in f]
                shapley[one] += len(removed)
                steps.append((part, "".join(order), step, one, len(left), len(removed), sum(one in f for _, f in rows) - len(removed),
                              sum(f == {one} for _, f in rows), sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed)))
        out += [(*s[:3], *s[4:], shapley[s[3]]) for s in steps]
    return out


def test_audit_matches_brute_force(spark):
    rng = random.Random(8)
    base = [words_of(rng, rng.choice([0, 3, 210, 260]), rng.choice([20, 4000])) + rng.choice(["", " #", " A" * 40, " ß|ü"]) for _ in range(40)]
    docs = [(i, rng.choice(base), rng.choice(["a", "b", None, ""])) for i in range(150)]
    docs += [(3, docs[3][1], "b"), (3, docs[3][1], "a"), (3, "other", "b"), (None, base[0], "a"), (None, base[0], None), (500, None, "a"), (501, "", "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, mask int, id string").repartition(4)
    told = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = [tuple(r) for r in filter_audit.audit(table, told).collect()]
    assert Counter(got) == Counter(brute_audit(docs, labels))


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert Counter(tuple(r) for r in filter_audit.audit(docs, labels).collect()) == Counter(brute_audit([(1, "a", "s")], []))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_plain_changes_visit_every_order_once(n):
    order, seen = list(range(n)), set()
    for level in [None, *filter_audit.plain_changes(n)]:
        if level is not None:
            order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n) == len(filter_audit.plain_changes(n)) + 1


def test_diagram_shares_equal_nodes_and_survives_swaps():
    rng = random.Random(2)
    weights = {m: (rng.randrange(3),) for m in range(32)}
    diagram = filter_audit.Diagram(5, weights)
    assert len(filter_audit.Diagram(5, {}).nodes) == 6  # one node a level
    for _ in range(200):
        diagram.swap(rng.randrange(4))
        before = 0
        for one, kept, removed in diagram.steps():
            assert removed[0] == sum(w[0] for m, w in weights.items() if m >> one & 1 and not m & before)
            before |= 1 << one
            assert kept[0] == sum(w[0] for m, w in weights.items() if not m & before)


# --------------------------------------------------------------- op13 ----

def shingle_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute_classes(docs):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text), least ids first, null ids last."""
    sets, root = [shingle_words(t) for _, t in docs], list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(sets[i]), least.get(top(i)), doc == least.get(top(i))) for i, (doc, _) in enumerate(docs)]


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(9000)}"
    return words


def near_texts(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "one", "One", "two words", "TWO\twords", "a b c d", "a b c d e", "É é", "é é"]
    for _ in range(20):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, 7)):
            out.append(" ".join(changed(rng, base, rng.randint(0, 2))))
    # a chain: neighbours are similar, its ends are not
    chain = [f"c{i}" for i in range(80)]
    for _ in range(12):
        chain = changed(rng, chain, 1)
        out.append(" ".join(chain))
    # texts around one, similar to it but hardly to each other
    hub = [f"h{i}" for i in range(70)]
    out += [" ".join(hub)] + [" ".join(changed(rng, hub, 1)).upper() for _ in range(25)]
    return out


@pytest.mark.parametrize(("seed", "rounds", "block"), [(1, 2, 512), (2, 0, 3), (3, 1, 2)])
def test_classes_match_brute_force(spark, monkeypatch, seed, rounds, block):
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(seed)
    ids = rng.sample(range(-500, 5000), 400)
    docs = list(zip(ids, near_texts(seed)))
    docs += [(ids[0], docs[40][1]), (docs[30][0], docs[30][1]), (None, docs[50][1]), (None, "null only one two three four"), (None, None)]
    table = spark.createDataFrame([(*d, "x", 1.0, b"y") for d in docs], "doc_id long, text string, node string, id double, sh binary").repartition(3)
    got = [tuple(r) for r in near_dedup.near_duplicates(table).collect()]
    expected = [(doc, n, component, doc == component if doc is not None else component is None) for doc, n, component, _ in brute_classes(docs)]
    assert Counter(got) == Counter(expected)


def test_star_rounds_join_a_large_group_without_pairs(spark):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(changed(rng, base, rng.randint(0, 2)))) for i in range(900)]
    rows = near_dedup.rows_of(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    nodes = rows.selectExpr("substring(sh, 1, 16) AS node", "size", "signs AS data").distinct()
    buckets = near_dedup.buckets_of(nodes)
    n = near_dedup.star_candidates(near_dedup.divided(buckets, None), 0).count()
    assert n <= 900 * near_dedup.LEADERS * 2
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.component_id) for r in got.collect()} == {0}


def test_near_duplicates_of_empty_and_bare_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0
    bare = spark.createDataFrame([(2, None), (1, " "), (2, "")], "doc_id long, text string")
    assert Counter(tuple(r) for r in near_dedup.near_duplicates(bare).collect()) == Counter([(2, 0, 2, True), (1, 0, 1, True), (2, 0, 2, True)])


def test_common_nodes_are_looked_up_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", 3)
    docs = [(i, "the same five words here") for i in range(50)] + [(90 + i, f"{i} other words for this row") for i in range(5)] + [(80, None)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: 0 if i < 50 else i for i, _ in docs}


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    equal = rng.random((3000, near_dedup._VALUES)) < 0.85
    table = np.where(equal, 0, 1).astype(np.uint16)
    assert len(near_dedup.sequentially(np.zeros((1, near_dedup._VALUES), np.uint16), table, 85, near_dedup.MISS)) == 3000
    far = np.where(rng.random((3000, near_dedup._VALUES)) < 0.5, 0, 1).astype(np.uint16)
    assert len(near_dedup.sequentially(np.zeros((1, near_dedup._VALUES), np.uint16), far, 85, near_dedup.MISS)) == 0
    assert (1 - 0.85**near_dedup.ROWS) ** near_dedup.BANDS < 1e-7


def test_names_sort_like_ids(spark):
    from pyspark.sql import functions as F

    ids = [None, -(1 << 63), -5, -1, 0, 1, 255, 256, (1 << 63) - 1]
    rows = spark.createDataFrame([(i, 7) for i in ids], "id long, th long")
    named = rows.select("id", near_dedup.node_name(F.col("id"), F.col("th")).alias("name")).select("id", "name", near_dedup.id_of(F.col("name")).alias("back")).collect()
    assert all(r.id == r.back for r in named)
    assert [r.id for r in sorted(named, key=lambda r: bytes(r.name))] == ids[1:] + [None]
