"""Chat formatting, quality rules, packing, token counts, byte-level BPE: brute force and edge cases."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from cardsentry.llm import byte_bpe, chat_format, packing, quality_rules, token_count

DOCS = "doc_id long, text string"
RANKS, JSON, MODEL = (P.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def odd_texts(n=300, seed=5):
    rng = random.Random(seed)
    signs = " \n\t  \x1c\x85 ²½Ⅳ一éab▁é日🙂<>s/0A' \x00‍中\\%"
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return made + ["", " ", "  lead", "trail   ", "</s> <s> <unk> <0x0A> x", "<|endoftext|> a<|endoftext|>", "we're we'll 'tis  x\r\n\ty", "a" * 3000, "日本語テキスト" * 50]


# ---------------------------------------------------------------- op1 ----

CHAT = "conv_id long, turn long, role string, text string, full string, walk int"


def chat(spark, rows):
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], CHAT)
    return chat_format.expand(given)


def test_chat_one_example_per_reply(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, "user", "more"), (1, 4, "assistant", "no")]
    got = sorted(chat(spark, rows).collect(), key=lambda r: r.example)
    assert [r.formatted for r in got] == ["[SYS]be kind[/SYS][INST]hi[/INST]<s>yes</s>",
                                          "[SYS]be kind[/SYS][INST]hi[/INST]<s>yes</s>[INST]more[/INST]<s>no</s>"]
    assert [r.formatted[r.loss_start : r.loss_end] for r in got] == ["yes", "no"]


def test_chat_read_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "<s", "<\\s>", "<\\\\/s>", "[\\INST]", "[ROLE]x[TEXT]", "[[INST]]", "é🙂<s><s>", "$1 \\1", ""]
    roles = ["user", "assistant", "system", "tool", "[ROLE]", "", None, "a[TEXT]b"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice([*nasty, None])) for c in range(30) for t in range(rng.randint(1, 6))]
    rows += [(40, 0, "user", "tie"), (40, 0, "user", "tie"), (40, 0, "assistant", "b"), (40, None, "user", "first"), (None, 0, "user", "no id")]
    got = {r.conv_id: r for r in chat_format.digest(chat(spark, rows)).collect()}
    by = {}
    for c, *rest in rows:
        by.setdefault(c, []).append(rest)
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = sorted(((t if t is not None else -1), r or "", x or "") for t, r, x in turns)
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_empty(spark):
    assert chat_format.digest(chat(spark, [])).count() == 0


# ---------------------------------------------------------------- op7 ----

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_base_figures(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", *odd_texts(100)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(5, 60))) for _ in range(60)]
    texts += ["a b c d e f g h " * 4, "x y\nx y\n\n x y\nz", "w" * 50_000, " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(20)))]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], DOCS + ", n_words string, kept int")
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs, ordered=True, rules=quality_rules.default_rules()).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(t), t
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.rejected_by is None) and (r.kept is False or not r.base_failed)


def test_quality_order_does_not_change_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rules = quality_rules.default_rules()
    runs = [quality_rules.apply_rules(docs, r, ordered=True).select("doc_id", "kept") for r in (rules, rules[::-1])]
    assert sorted(runs[0].collect()) == sorted(runs[1].collect())
    assert {r.name for r in quality_rules.order_rules(docs, rules)} == {r.name for r in rules}


def test_quality_keep_carries_rows(spark):
    prose = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, prose, 5, "a"), (1, prose, 5, "a"), (2, None, 6, "b"), (3, "# " * 40, 1, "c")], DOCS + ", n_words int, given string")
    assert sorted(map(tuple, quality_rules.keep(docs).collect())) == [(1, prose, 5, "a")] * 2
    assert quality_rules.keep(docs.limit(0)).columns == docs.columns and quality_rules.keep(docs.limit(0)).count() == 0


# ------------------------------------------------------------ op2, 3, 4 ----

def test_packing_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    texts = [None, *odd_texts(), "w " * 3000, "word " * 1023, "word " * 1024]
    docs = spark.createDataFrame([(i if i % 50 else None, t, "x") for i, t in enumerate(texts)], DOCS + ", row string")
    got = packing.pack_documents(docs, JSON, capacity=256).collect()
    tool = Tokenizer.from_file(JSON)
    want = Counter(np.array([*tool.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts)
    whole, places = {}, {}
    for r in got:
        assert len(r.token_ids) == 4 * r.length and 1 <= r.length <= 256
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id is not None:
            whole.setdefault(r.doc_id, {})[r.piece] = (r.start, bytes(r.token_ids))
    for pieces in whole.values():
        lengths = [len(pieces[k][1]) // 4 for k in sorted(pieces)]
        assert all(n == 256 for n in lengths[1:]) and [pieces[k][0] for k in sorted(pieces)] == [sum(lengths[:k]) for k in range(len(lengths))]
        want.subtract([b"".join(pieces[k][1] for k in sorted(pieces))])
    assert sum(want.values()) == sum(1 for i in range(len(texts)) if i % 50 == 0) and min(want.values()) == 0
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in got)
    assert len(places) <= -(-total // 256) * 1.03 + 1


def best_fit_bins(lengths, capacity):
    gaps = []
    for s in lengths:
        fits = [g for g in gaps if g >= s]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - s)
    return len(gaps)


@pytest.mark.parametrize("capacity", [7, 40])
def test_packing_places_where_the_sum_of_squares_becomes_smallest(capacity):
    rng = np.random.default_rng(capacity)
    for n in (0, 1, 30, 300):
        lengths = rng.integers(1, capacity + 1, n)
        bins, offset = packing.place(lengths, capacity)
        used = {}
        for i in np.argsort(-lengths, kind="stable").tolist():
            def squares(b):
                after = Counter(capacity - u for u in (used | {b: used.get(b, 0) + lengths[i]}).values() if u < capacity)
                return sum(c * c for c in after.values())
            room = [b for b, u in used.items() if u + lengths[i] <= capacity]
            b = int(bins[i])
            assert offset[i] == used.get(b, 0)
            assert b in room and squares(b) == min(map(squares, room)) if room else b not in used
            used[b] = used.get(b, 0) + int(lengths[i])
        assert all(u <= capacity for u in used.values())


def test_packing_is_tight():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 4000):
        lengths = rng.integers(1, 1024, n)
        bins, offset = packing.place(lengths, 1024)
        for b in np.unique(bins):
            mine = np.argsort(offset[bins == b])
            sizes = lengths[bins == b][mine]
            assert sizes.sum() <= 1024 and (offset[bins == b][mine] == np.cumsum(sizes) - sizes).all()
    falling = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    assert len(np.unique(bins)) <= best_fit_bins(lengths[falling], 1024) * 1.015  # uniform lengths suit best fit
    assert len(np.unique(packing.place(np.array([512] * 7), 1024)[0])) == 4


def test_packing_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS), JSON).count() == 0


def test_token_counts_match_the_library(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(token_count, "CHUNK", 64)
    tool = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [None, *odd_texts(), "long text of words " * 400, "x" * 5000, " " * 500]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, "twice " * 60, 1)] * 2, DOCS + ", n_tokens int")
    got = [tuple(r) for r in token_count.count_tokens(docs, MODEL).collect()]
    want = [(i, len((t or "").encode()), len(tool.encode(t or ""))) for i, t in enumerate(texts)] + [(0, 360, len(tool.encode("twice " * 60)))] * 2
    assert sorted(got) == sorted(want)
    assert token_count.count_tokens(docs.limit(0), MODEL).count() == 0


def test_chunk_maps_compose_in_any_grouping():
    to = token_count.transducer(MODEL)
    rng = random.Random(2)
    for text in [*odd_texts(60), "ab" * 40 + "a" * 33, "x" * 50, "漢字" * 30]:
        if not text:
            continue
        marked = token_count.MARK + text.replace(" ", token_count.MARK)
        maps, entries = [], {token_count._name(token_count.START)}
        for i in range(0, len(marked), 5):
            before = marked[max(0, i - 7) : i]
            if before:
                entries.add(to.entry(before))  # a guess, right or wrong
            maps.append({e: to.cross(e, before, marked[i : i + 5]) for e in entries})
            entries = {left for left, _ in maps[-1].values()}
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i : i + 2] = [token_count.compose(maps[i], maps[i + 1])]
        left, n = maps[0][token_count._name(token_count.START)]
        assert n + to.rest(to._number(token_count._state(left))) == token_count._counts(to, text)


def test_texts_without_blanks_across_chunks(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(token_count, "CHUNK", 100)
    monkeypatch.setattr(token_count, "BEFORE", 3)  # guesses that are often wrong
    monkeypatch.setattr(token_count, "RUN", 4)
    rng = random.Random(6)
    texts = ["a" * 637, "ab" * 300, "http" * 151, "=" * 399 + " " * 255, "".join(rng.choice("abcdefXYZ+/=") for _ in range(1500)), "漢字かな" * 120, "é€😀" * 150]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, MODEL).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_memos_are_bounded_by_bytes(monkeypatch):
    from cardsentry.llm.common import Remembered

    memo = Remembered(lambda t: t * 2, 10_000)
    for i in range(5000):
        assert memo[f"w{i}"] == f"w{i}" * 2
        assert memo["x" * 100] == "x" * 200
    assert memo.used <= 5_000 and len(memo) + len(memo.older) < 110 and "x" * 100 not in memo
    monkeypatch.setattr(token_count, "COMPILED", 100_000)
    to = token_count.Transducer(token_count.transducer(MODEL).scores)
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij+/=漢字") for _ in range(30_000))
    import sentencepiece

    assert to.run(token_count.MARK + text) == len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text))
    assert to.used <= 150_000 and len(to.fits) < 1300


def test_a_pair_is_given_up_at_its_border():
    to = token_count.transducer(P.path("piece_bpe_32k.model"))
    pieces = sorted(to.scores)[::97]
    for a, b in zip(pieces, reversed(pieces)):
        whole = to.merged(a + b)
        assert to.merged(a + b, len(a)) in ([], whole) and to.compatible(a, b) == (whole == [a, b])
    assert to.merged("the", 1) == [] and to.merged("the") != []


def test_packing_remembers_a_large_vocabulary(monkeypatch):
    to = packing.JsonTokenizer(P.path("byte_bpe_50k.json"))
    words = [f" w{i:06d}" for i in range(200_000)]
    text = "".join(words)
    first, found = to.encode(text), []
    monkeypatch.setattr(to.words, "find", lambda w: found.append(w) or to._word(w))
    assert to.encode(text) == first and not found


def test_words_are_remembered_without_their_signs():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    to = token_count.Transducer(token_count.transducer(MODEL).scores)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 9))) for _ in range(100)] + ["слово", "漢字", "", "▁", "▁▁x"]
    ends = [",", ".\n", "$$$", "))", "7", "2024", "Ж", "漢", "😀", "\x00", "─═", "...\r\n"]
    texts = [f"{a}{end} {b}{end}{a}" for a in words for b in words[::9] for end in ends]
    assert [token_count._counts(to, t) for t in texts] == [len(x) for x in library.encode(texts)]
    assert len(to.stretches) < 1000  # not one for each pair of a word and an end


def test_pairs_judged_by_their_borders_merge_alike():
    to = token_count.Transducer(token_count.transducer(MODEL).scores)
    rng, pieces = random.Random(4), sorted(to.reachable)
    pairs = [(rng.choice(pieces), rng.choice(pieces)) for _ in range(3000)] + [(p[:n], p[n:]) for p in pieces[::25] for n in range(1, len(p))]
    for a, b in pairs:
        if a in to.reachable and b in to.reachable:
            assert to.compatible(a, b) == (to.merged(a + b) == [a, b])
    odd = token_count.Transducer({"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0, "ab": -5.0, "abc": -1.0, "cd": -3.0})
    for text in ("abcd", "abc", "cdabc", "ababcdcd", "aabbccdd", "abcabcd", "cdcd"):  # merges that get better on the way
        assert odd.run(text) == len(odd.merged(text))
