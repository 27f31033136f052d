"""Jaccard join, secrets, licenses, neighbours, WARC and the pipeline: brute force, planted and edge cases."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pytest

from cardsentry.llm import components, jaccard_join, license_scan, permutation_index, secret_scan, warc
from cardsentry.llm.common import shared_folder, shingles, word_hashes

DOCS = "doc_id long, text string"


# ---------------------------------------------------------------- op5 ----

def shingle_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute_join(texts):
    """links and class (least index) of every text."""
    sets = [shingle_words(t) for t in texts]
    links, root = Counter(), list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return links, [top(i) for i in range(len(texts))]


def near_texts(seed=4):
    rng = random.Random(seed)
    out = [None, "", " ", "one", "one", "two words", "two words", "a b c d", "a b c d e"]
    for _ in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(6, 80))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [512, 3])
def test_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, "x", b"y") for i, t in enumerate(texts)], DOCS + ", node string, th binary")
    links, classes = brute_join(texts)
    got = {r.doc_id: r for r in jaccard_join.join(docs).collect()}
    assert len(got) == len(texts)
    assert {i: got[i].n_links for i in got} == {i: links[i] for i in range(len(texts))}
    assert {i: got[i].class_id for i in got} == dict(enumerate(classes))


def test_join_edge_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard_join.join(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0
    text = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text, 1), (7, text, 2), (7, text, 2), (8, None, 3), (8, None, 3)], DOCS + ", row int")
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, None, 2), (7, None, 2), (7, None, 2), (8, 8, 0), (8, 8, 0)], key=str)
    kept = [tuple(r) for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([(None, text, 1), (8, None, 3), (8, None, 3)], key=str)


def test_keep_one_of_each_class(spark):
    texts = near_texts(9)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], DOCS + ", row int")
    _, classes = brute_join(texts)
    bare = {i for i, t in enumerate(texts) if not shingle_words(t)}
    assert {r.doc_id for r in jaccard_join.keep_one(docs).collect()} == set(classes) | bare


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    equal = rng.random((20_000, 128)) < 0.8
    signs = np.zeros((2, 128), np.uint16)
    dropped = 0
    for row in equal[:2000]:
        signs[1] = np.where(row, 0, 1)
        dropped += not len(jaccard_join.surviving(signs, np.array([0]), np.array([1]), 0.8, jaccard_join.TOLERANCE))
    assert dropped == 0
    assert (1 - 0.8**jaccard_join.ROWS) ** jaccard_join.BANDS < 1e-7


def test_word_hashes_do_not_depend_on_place_or_block(monkeypatch):
    from cardsentry.llm import common

    text = " ".join(f"wörd{i % 97}" for i in range(3000)).encode()
    whole = word_hashes(text)
    assert len(set(whole.tolist())) == 97 and len(whole) == 3000
    monkeypatch.setattr(common, "_BLOCK", 100)
    assert (word_hashes(text) == whole).all()
    assert len(shingles(whole[:3], 5)) == 1 and len(shingles(whole[:0], 5)) == 0


def test_word_longer_than_a_block(monkeypatch):
    from cardsentry.llm import common

    long = np.random.default_rng(9).integers(97, 123, 3 * common._BLOCK + 77, dtype=np.uint8).tobytes()
    here, there = word_hashes(b"a bb " + long + b" c"), word_hashes(b"other words before\n" + long)
    assert len(here) == 4 and len(there) == 4 and here[2] == there[3] and len(word_hashes(long)) == 1
    short = word_hashes(b"x " + long[:5000] + b" y")
    monkeypatch.setattr(common, "_BLOCK", 100)
    assert (word_hashes(b"x " + long[:5000] + b" y") == short).all()
    monkeypatch.undo()
    text = f"{long.decode()} {license_scan.TEMPLATES['MIT']} {long.decode()}"
    found = license_scan.Matcher(license_scan.TEMPLATES).find(text)
    assert [(m[0], text[m[2] : m[3]]) for m in found] == [("MIT", license_scan.TEMPLATES["MIT"])]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 5)]
    got = {r.vertex: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 200: 200}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# ---------------------------------------------------------------- op8 ----

SECRET = "password = hunter2secret"


@pytest.mark.parametrize("hidden", [
    urllib.parse.quote(SECRET, safe=""), base64.b64encode(SECRET.encode()).decode(), base64.b64encode(base64.b64encode(SECRET.encode())).decode(),
    base64.urlsafe_b64encode(b"\xc3\xbf\xc3\xbf " + SECRET.encode()).decode(), base64.b64encode(gzip.compress(SECRET.encode())).decode(), base64.b64encode(zlib.compress(SECRET.encode())).decode(),
    "".join(f"\\u{ord(c):04x}" for c in SECRET), "".join(f"&#{ord(c)};" for c in SECRET),
    urllib.parse.quote(base64.b64encode(gzip.compress(urllib.parse.quote(SECRET).encode())).decode(), safe=""),
])
def test_hidden_secret_is_found_at_its_place(hidden):
    text = f"é🙂 before {hidden} after"
    base, added, exhausted = secret_scan.scan(text)
    assert not exhausted and [k for k, _, _ in added] == ["assign"]
    at = text.index(hidden)
    assert at <= added[0][1] < added[0][2] <= at + len(hidden)
    assert secret_scan.redacted(text).startswith("é🙂 before ") and "[assign]" in secret_scan.redacted(text)


@pytest.mark.parametrize("hidden", [
    r"{\u0022password\u0022: \u0022hunter2abc\u0022}", "&#34;token&#34;: &#34;abcdef123&#34;", "password%3A hunter2secret",
    "password %253D hunter2secret", r"%70assword \u003a hunter2secret", "password: token%3Aabcdefgh",
])
def test_key_and_value_in_different_words(hidden):
    text = f"é🙂 some words before {hidden} and some after"
    base, added, exhausted = secret_scan.scan(text)
    assert not base and not exhausted and {k for k, _, _ in added} == {"assign"}
    at = text.index(hidden)
    assert all(at <= a < b <= at + len(hidden) for _, a, b in added)
    assert not re.search("hunter2|abcdef", secret_scan.redacted(text))


def test_base_spans():
    text = 'Token: "abcdef" api_key=xy password=short1 SECRET = a=b=c=d AKIA' + "A" * 16 + " AKIA123 " + "0a" * 12 + " " + "0" * 23
    got = secret_scan.base_spans(text)
    assert [(k, text[a:b]) for k, a, b in got] == [
        ("assign", 'Token: "abcdef'), ("assign", "password=short1"), ("assign", "SECRET = a=b=c=d"), ("access", "AKIA" + "A" * 16), ("hex", "0a" * 12)]
    assert secret_scan.scan("ſecret=abcdefgh")[0] == []


def test_clean_text_and_guard():
    assert secret_scan.scan("100% of plain words, %%% &&& \\u12 &#; " + "longwordwithoutanyblank" * 20) == ([], [], False)
    bomb = base64.b64encode(gzip.compress(b"a" * 100_000)).decode()
    assert secret_scan.scan(bomb, 1000)[2]


@pytest.mark.parametrize("packed", [lambda x: x, gzip.compress, zlib.compress, lambda x: gzip.compress(x[:1500]) + gzip.compress(x[1500:2000]) + gzip.compress(x[2000:])])
@pytest.mark.parametrize("width,end", [(76, "\n"), (64, "\r\n  "), (75, "\n")])
def test_wrapped_base64_and_members(packed, width, end):
    rng = random.Random(7)
    words = " ".join(f"é{rng.randrange(10**6)}" for _ in range(300))
    for code in (base64.b64encode, base64.urlsafe_b64encode):
        for more in range(4):  # last lines of several lengths
            run = code(packed(f"{words} {SECRET} {words}{'.' * more}".encode())).decode()
            wrapped = end.join(run[i : i + width] for i in range(0, len(run), width))
            for before in ("see\n", "data:text/plain;base64,", "-----BEGIN X-----\nsomelongheaderword16\n"):
                text = f"é {before}{wrapped}\nend"
                base, added, exhausted = secret_scan.scan(text)
                assert not base and not exhausted and {k for k, _, _ in added} == {"assign"}
                at = text.index(wrapped)
                assert all(at <= a < b <= at + len(wrapped) for _, a, b in added)
    one = base64.b64encode(packed(f"{words} {SECRET}".encode())).decode()
    assert [k for k, _, _ in secret_scan.scan(one)[1]] == ["assign"]


def _b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("raw", [
    b"password=hunter2secret\x00", b"\x01\x02password=hunter2secret\x7f\xff\xfe", "password=hunter2secret".encode("utf-16"),
    "password=hunter2secret".encode("utf-16-be"), b"x" + "password=hunter2secret".encode("utf-16-le"), "é ü password=hunter2secret ß".encode("latin-1"),
    gzip.compress("é password=hunter2secret".encode("latin-1")), gzip.compress("password=hunter2secret".encode("utf-16")),
    gzip.compress(b"\x00\x01 password=hunter2secret \xff"), zlib.compress(b"password=hunter2secret\x00"), _b64(b"password=hunter2secret\x00").encode(),
    b"\xff" + gzip.compress(b"password=hunter2secret")])
@pytest.mark.parametrize("before", ["", "a/", "ab+", "https://h.org/ab/", "x" * 9 + "/"])
def test_decoded_layers_with_other_bytes_and_phases(raw, before):
    text = f"see {before}{_b64(raw)} there"
    base, added, exhausted = secret_scan.scan(text)
    at = text.index(_b64(raw).rstrip("=")[:12])
    assert not base and not exhausted
    assert any(k == "assign" and at - 16 <= a < b <= at + len(_b64(raw)) + 3 for k, a, b in added)
    assert "hunter2" not in secret_scan.redacted(text) and _b64(raw)[8:-8] not in secret_scan.redacted(text)


def test_spans_of_shifted_and_wide_layers_are_exact():
    secret = "token=abcdef123456"
    for encoding, width in (("latin-1", 1), ("utf-16-le", 2)):
        raw = ("é" * 3).encode(encoding) + secret.encode(encoding) + b"\xff"
        for before in ("", "a/", "ab/", "abc/"):
            text = before + _b64(raw)
            _, added, _ = secret_scan.scan(text)
            first, last = 3 * width, (3 + len(secret)) * width
            want = (len(before) + first * 4 // 3, len(before) - (-last * 4 // 3))
            assert any(k == "assign" and abs(a - want[0]) <= 2 and abs(b - want[1]) <= 3 for k, a, b in added), (encoding, before, added, want)


def test_escape_dense_text_in_bounded_memory():
    import tracemalloc

    text = "plain words %41bc " * 60_000 + "token%3Dabcdef123456"
    tracemalloc.start()
    _, added, _ = secret_scan.scan(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [k for k, _, _ in added] == ["assign"] and peak < 60 * len(text)


def test_large_parts_do_not_end_the_document():
    rng = random.Random(6)
    words = " ".join(f"é{rng.randrange(10**6)}" for _ in range(3000))
    big = base64.b64encode(gzip.compress(f"{words} {SECRET}".encode())).decode()
    later = base64.b64encode(zlib.compress(b"key AKIA" + b"B" * 16)).decode()
    text = f"{big} and {urllib.parse.quote(SECRET, safe='')} and {later} end"
    for most in (999, 1000, 1001, 25_000):
        base, added, exhausted = secret_scan.scan(text, most)
        assert exhausted and not base and [k for k, _, _ in added] == ["assign", "assign", "access"]
        assert added[0] == ("assign", 0, len(big)) and text[slice(*added[2][1:])] == later
        assert secret_scan.redacted(text, most) == "[assign] and [assign] and [access] end"
    clean = base64.b64encode(gzip.compress(words.encode())).decode()
    assert secret_scan.redacted(f"a {clean} b", 1000) == "a [encoded] b" and secret_scan.redacted(f"a {clean} b") == f"a {clean} b"
    escaped = urllib.parse.quote("x y " * 500, safe="") + f" {later}"  # escapes are no compressed parts
    assert [k for k, _, _ in secret_scan.scan(escaped, 1000)[1]] == ["access"] and not secret_scan.scan(escaped, 1000)[2]


def test_find_and_redact_rows(spark):
    rows = [(1, SECRET, "x"), (1, SECRET, "x"), (2, None, "y"), (3, "", "z"), (4, "clean", None)]
    docs = spark.createDataFrame(rows, DOCS + ", base string")
    got = sorted(((r.doc_id, len(r.base), len(r.added)) for r in secret_scan.find_secrets(docs).collect()))
    assert got == [(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0)]
    assert sorted(map(tuple, secret_scan.redact(docs).collect()), key=str) == sorted(
        [(1, "[assign]", "x"), (1, "[assign]", "x"), (2, None, "y"), (3, "", "z"), (4, "clean", None)], key=str)
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


# --------------------------------------------------------------- op10 ----

def test_every_template_is_found_at_its_place():
    to = license_scan.Matcher(license_scan.TEMPLATES)
    rng = random.Random(8)
    for name, template in license_scan.TEMPLATES.items():
        for _ in range(12):
            before = " ".join(f"wörd{rng.randrange(99)}" for _ in range(rng.randrange(40)))
            text = f"{before}\n{template.upper()}. {before}"
            start = len(before) + 1
            assert any(m[0] == name and m[1] == 1 and (m[2], m[3]) == (start, start + len(template)) for m in to.find(text)), name


def test_partial_license():
    to = license_scan.Matcher(license_scan.TEMPLATES)
    words = license_scan.TEMPLATES["MIT-grant"].split()
    assert any(m[0] == "MIT-grant" for m in to.find(" ".join(words[:-3])))
    assert not to.find(" ".join(words[: len(words) // 2])) and not to.find("plain prose about software and licenses of all kinds")


def test_sister_licenses_are_told_apart():
    to = license_scan.Matcher(license_scan.TEMPLATES)
    for name in license_scan.DECIDING:
        for around in ("{}", "as said here before {} and then other words follow", "{} {}"):
            text = around.replace("{}", license_scan.TEMPLATES[name])
            others = {m[0] for m in to.find(text)} - {"Apache-2.0"} if name == "Apache-2.0-header" else {m[0] for m in to.find(text)}
            assert others == {name}, text
    for text in ("This work is licensed under the GNU General Public License, version 1", license_scan.TEMPLATES["MPL-2.0"].replace("2.0", "1.1"),
                 "This work is licensed under a Creative Commons Attribution-Other 4.0 International License"):
        assert not to.find(text), text
    own = {"GPL-3.0": "three plain words of another text"}
    assert [m[0] for m in license_scan.Matcher(own).find(own["GPL-3.0"])] == ["GPL-3.0"]


@pytest.mark.parametrize("line, name", [
    ("This project is licensed under the MIT License", "MIT"), ("Licensed under the MIT license.", "MIT"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "GPL-3"), ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"),
    ("Apache License\n  Version 2.0, January 2004", "Apache-2.0"), ("covered by the Mozilla Public License 2.0 as given here", "MPL-2.0"),
    ("this text is under CC BY-SA 3.0 only", "CC-BY-SA-3.0"), ("BSD 3-Clause License", "BSD-3-Clause"),
    ("Creative Commons Attribution-ShareAlike 3.0 Unported", "CC-BY-SA-3.0"), ("the GNU GPL v2 or later", "GPL-2")])
def test_titles_and_short_forms(line, name):
    found = license_scan.Matcher(license_scan.TEMPLATES).find(line)
    assert {m[0].split(":")[0] for m in found} == {name}


def test_parts_of_a_larger_template_are_told_once():
    to = license_scan.Matcher(license_scan.TEMPLATES)
    whole = license_scan.TEMPLATES["MIT-full"]
    assert [m[0] for m in to.find(whole)] == ["MIT-full"]
    apart = f"{license_scan.TEMPLATES['Warranty-disclaimer']} {'other words here ' * 300} {whole}"
    assert [m[0] for m in to.find(apart)] == ["Warranty-disclaimer", "MIT-full"]
    three = " ".join(license_scan.TEMPLATES[n] for n in ("BSD-redistribution", "BSD-2-Clause-conditions", "BSD-3-Clause-endorsement"))
    assert {m[0] for m in to.find(three)} == {"BSD-redistribution", "BSD-2-Clause-conditions", "BSD-3-Clause-endorsement"}


def test_licenses_equal_brute_force_containment():
    """Every template against every window of every text, by word triples; deciding words and parts as stated."""
    templates, to, rng = license_scan.TEMPLATES, license_scan.Matcher(license_scan.TEMPLATES), random.Random(21)

    def words(text):
        return re.findall("[^ \\t\\n\\x0b\\f\\r]+", re.sub("[\x00-\x08\x0e-\x1f!-/:-@\\[-`{-\x7f]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)))

    def triples(w):
        return [tuple(w[i : i + 3]) for i in range(len(w) - 2)]

    sets = {n: set(triples(words(x))) for n, x in templates.items()}
    deciding = {n: words(license_scan.DECIDING.get(n, license_scan._EXACT.get(n, ""))) for n in templates}

    def brute(text):
        w = words(text)
        there, out = triples(w), {}
        for n, wanted in sets.items():
            length = len(words(templates[n])) - 2
            for at in range(max(1, len(there) - length + 1)):
                held = [i for i in range(at, min(at + length, len(there))) if there[i] in wanted]
                if len({there[i] for i in held}) >= license_scan.CONTAINMENT * len(wanted):
                    a, b, d = held[0], held[-1] + 3, deciding[n]
                    if not d or any(w[i : i + len(d)] == d for i in range(a, b - len(d) + 1)):
                        out.setdefault(n, []).append((a, b))
        return {n for n, spans in out.items()
                if any(not any(sets[n] < sets[u] and a <= c and d <= b for u in out for a, b in out[u]) for c, d in spans)}

    names = sorted(templates)
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [f"prose{rng.randrange(30)}" for _ in range(rng.randrange(12))]
            given = templates[rng.choice(names)].split()
            if rng.random() < 0.4:
                given[rng.randrange(len(given))] = "altered"
            parts += given
        text = " ".join(parts)
        assert {m[0] for m in to.find(text)} == brute(text), text
    clean = " ".join(rng.choice("the license of a public general work is version under terms software free".split()) + f" {rng.choice('abc')}" for _ in range(400))
    assert to.find(clean) == [] and brute(clean) == set()


def test_license_rows(spark):
    text = license_scan.TEMPLATES["MIT"]
    docs = spark.createDataFrame([(1, text, 1), (1, text, 1), (2, None, 2), (3, "", 3)], DOCS + ", license int")
    assert [r.license for r in license_scan.scan(docs).collect()] == ["MIT", "MIT"]
    assert license_scan.licenses_of(docs).count() == 1 and license_scan.licenses_of(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- op9 ----

def test_neighbours_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)).round(3)
    x[100:400] = x[7]  # a tenth of all rows are copies
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(5000, None, "x"), (5100, [], "x"), (5200, [0.0] * 24, "x"), (5300, [float("nan")] * 24, "x"), (5400, [None] * 24, "x"), (0, x[0].tolist(), "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in permutation_index.search(df, permutation_index.F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 3000, 100)) and all(sorted(g) == list(range(1, 11)) for g in got.values())
    found = 0
    for q, g in got.items():
        far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        want = np.lexsort((np.arange(3000), far))[:10]
        found += len(set(want.tolist()) & {v for v, _ in g.values()})
        assert all(abs(far[v] - s) < 1e-12 for v, s in g.values())
    assert found >= 0.9 * 300


def test_neighbours_in_tight_clusters(spark):
    rng = np.random.default_rng(12)
    x = np.repeat(rng.normal(size=(10, 32)) * 5, 1500, axis=0) + 0.05 * rng.normal(size=(15_000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    got = {}
    for r in permutation_index.search(df, permutation_index.F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(got) == 150
    found = 0
    for q, g in got.items():
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        found += len(g & set(np.argsort(far)[:10].tolist()))
    assert found >= 0.95 * 1500


def test_few_vectors(spark):
    df = spark.createDataFrame([(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = permutation_index.search(df, permutation_index.F.col("id") % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == [(100, 1, 1, 0.0), (100, 2, 2, round(2**0.5, 9))]
    assert permutation_index.search(df.limit(0), permutation_index.F.col("id") % 100 == 0).count() == 0


def test_neighbours_beyond_thousands_of_copies(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "FILE_BLOCK", 512)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 16))
    query = x[0].copy()
    ids = rng.permutation(np.arange(1, 6000)) * 100 + 1  # none is a query
    x[1:4001] = query + 0.02 * rng.normal(size=16)  # one vector, four thousand times
    for i in range(4001, 4006):
        x[i] = query + 0.015 * rng.normal(size=16)
    rows = [(0, query.tolist()), *((int(i), v.tolist()) for i, v in zip(ids, x[1:]))]
    rows.append((200, x[1].tolist()))  # a query among the copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in permutation_index.search(df, permutation_index.F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    every, at = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    for q in (0, 200):
        far = np.sqrt(((at - at[every == q][0]) ** 2).sum(axis=1))
        far[every == q] = np.inf
        want = np.lexsort((every, far.round(12)))[:10]
        assert [got[q][n][0] for n in range(1, 11)] == every[want].tolist()
        assert all(abs(got[q][n][1] - far[w]) < 1e-12 for n, w in enumerate(want, 1))


# ---------------------------------------------------------------- op6 ----

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "u1", "a" + FAKE), (2, "u2", FAKE), (3, "u3", "x" * 50), (4, "u4", "x" * 50), (5, "u5", None), (6, None, ""), (7, "u\r\n7", "pre WARC/1.0\r\n mid WARC/1.0\r\n"),
         (8, "u8", "WARC/1.0\r\n"), (9, "u9", FAKE[:-4]), (10, "u10", FAKE + FAKE + "tail"), (11, "u", "é" * 20), (12, "u12", "WARC/1.0\r\nContent-Length: 100000\r\n\r\nhello"),
         (13, "u", "after"), (14, "u14", "WARC/1.0\r\nContent-Length: 0\r\n\r\n")]


@pytest.mark.parametrize("files,split,least", [(1, "128m", 0), (3, "128m", 1), (1, "300b", 0), (1, "90b", 1)])
def test_warc_round_trip_with_magic_in_payloads(spark, files, split, least):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        path = shared_folder(spark, "warc-test")
        warc.write(spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, value int").coalesce(1).repartition(files), path, least_bytes=least)
        got = {r.record_id: r for r in warc.read(spark, path).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(got) == len(PAGES)
    for page, url, html in PAGES:
        payload = (html or "").encode()
        first = max(p for p, _, h in PAGES if (h or "") == (html or ""))
        r = got[f"<urn:page:{page}>"]
        revisit = first != page and len(payload) >= least
        assert (r.type, r.refers_to) == (("revisit", f"<urn:page:{first}>") if revisit else ("response", None))
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert r.payload is None if revisit else bytes(r.payload) == payload
        assert r.uri == (url or "").replace("\r", "%0D").replace("\n", "%0A")


def test_warc_empty_nulls_and_repeats(spark):
    schema = "page_id long, url string, html string"
    path = shared_folder(spark, "warc-test")
    warc.write(spark.createDataFrame([(None, None, "a"), (2, "u", "b"), (2, "u", "b"), (1, "u", "b")], schema), path)
    got = sorted((r.record_id, r.type, r.refers_to) for r in warc.read(spark, path).collect())
    assert got == sorted([("<urn:page:>", "response", None), ("<urn:page:2>", "response", None), ("<urn:page:2>", "response", None), ("<urn:page:1>", "revisit", "<urn:page:2>")], key=lambda x: x[0])
    path = shared_folder(spark, "warc-test")
    warc.write(spark.createDataFrame([], schema), path)
    assert warc.read(spark, path).count() == 0


# ------------------------------------------------------------ pipeline ----

def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    words = [f"word{i} and" for i in range(30)]
    clean = " ".join(words)
    near = clean.replace("word17", "other")
    other = " ".join(f"term{i} or" for i in range(40)) + f" {SECRET}"
    rows = [(1, clean, "en", "s", len(clean)), (2, clean, "en", "s", len(clean)), (3, near, "en", "s", len(near)), (4, other, "en", "t", len(other)),
            (5, "too short", "en", "t", 9), (6, None, None, None, None), (7, "# " * 60, "en", "t", 120)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string, source string, n_chars long")
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 4
    stage = dict(pipeline.STAGES)
    kept = stage[names[0]](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4] and kept.columns == docs.columns
    one = stage[names[1]](spark, kept, "")
    assert sorted(r.doc_id for r in one.collect()) == [1, 4] and one.columns == docs.columns
    safe = stage[names[2]](spark, one, "")
    told = {r.doc_id: r for r in safe.collect()}
    assert told[1].text == clean and "hunter2" not in told[4].text and told[4].n_chars == len(told[4].text) and safe.columns == docs.columns
    packed = stage[names[3]](spark, safe, "").collect()
    assert {r.doc_id for r in packed} == {1, 4} and len({r.sequence_id for r in packed}) == 1


def test_pipeline_over_a_table(spark):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id for r in got.select("doc_id").collect()} < set(docs) and got.count() > 50


# --------------------------------------------------------------- sieve ----

@pytest.mark.parametrize("words", [1 << 19, 2])
def test_sieve_never_loses_a_key(spark, monkeypatch, words):
    from cardsentry.llm import common

    monkeypatch.setattr(common, "SIEVE_WORDS", words)
    rows = spark.range(3000).selectExpr("IF(id = 0, NULL, id) AS a", "cast(id AS string) AS b", "'wide' AS c")
    keys = spark.range(0, 3000, 10).selectExpr("IF(id = 0, NULL, id) AS a", "cast(id AS string) AS b")
    may = {r.b for r in common.sieved(rows, keys, ["a", "b"]).collect()}
    other = {r.b for r in common.sieved(rows, keys, ["a", "b"], keep=False).collect()}
    assert not may & other and len(may | other) == 3000
    assert {str(i) for i in range(0, 3000, 10)} <= may
    assert len(may) < 400 if words > 2 else len(may) <= 3000
    assert common.sieved(rows, keys.limit(0), ["a", "b"]).count() == 0
