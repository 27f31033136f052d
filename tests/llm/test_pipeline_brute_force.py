"""The corpus pipeline, stage by stage, against plain Python and DuckDB over whole small tables."""

import re

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from cardsentry.llm import secret_scan, sql
from cardsentry.llm.common import saved

SF = "/root/testdata/sf0.01"


def shingle_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def least_of_classes(docs):
    """Ids of the least document of each class of similarity 0.8, of (doc_id, text)."""
    docs = sorted(docs)
    sets, root = [shingle_words(t) for _, t in docs], list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 10 * min(len(a), len(sets[j])) >= 8 * max(len(a), len(sets[j])) and 10 * len(a & sets[j]) >= 8 * len(a | sets[j]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {docs[i][0] for i in range(len(docs)) if top(i) == i}


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, saved(stage(spark, docs, SF), name.replace(" ", "-"))
        out.append((given, docs))
    return out


def test_quality_stage_keeps_what_the_sql_keeps(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.ORACLES['op7_quality_rules']}) WHERE kept").fetchall()}
    given, out = stages[0]
    rows = {r.doc_id: r for r in given.collect()}
    assert out.columns == given.columns and 0 < len(kept) < len(rows)
    assert sorted(map(str, out.collect())) == sorted(str(rows[i]) for i in kept)


def test_one_document_of_each_class_stays(stages):
    given, out = stages[1]
    rows = {r.doc_id: r for r in given.collect()}
    stay = least_of_classes([(i, r.text) for i, r in rows.items()])
    assert out.columns == given.columns and len(stay) < len(rows)
    assert sorted(map(str, out.collect())) == sorted(str(rows[i]) for i in stay)


def test_secrets_are_replaced_and_nothing_else(stages):
    given, out = stages[2]
    after = {r.doc_id: r for r in out.collect()}
    assert out.columns == given.columns and len(after) == given.count()
    changed = 0
    for row in given.collect():
        base = secret_scan.base_spans(row.text or "")
        new = after[row.doc_id]
        assert not secret_scan.base_spans(new.text or "") and new.n_chars == len(new.text)
        if not base and not secret_scan.scan(row.text or "")[1]:
            assert new.text == row.text
        else:
            changed += 1
            assert all(row.text[a:b] not in new.text for _, a, b in base)
        assert (new.lang, new.source) == (row.lang, row.source)
    assert changed


def test_pieces_are_the_librarys_tokens_packed_without_gaps(stages):
    from tokenizers import Tokenizer

    given, out = stages[3]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, bins = {}, {}
    for r in out.collect():
        ids = np.frombuffer(r.token_ids, "<u4").tolist()
        assert len(ids) == r.length <= 1024
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for row in given.collect():
        parts = sorted(pieces.pop(row.doc_id))
        joined = [i for _, _, ids in parts for i in ids]
        assert joined == library.encode(row.text or "", add_special_tokens=False).ids + [2]
        assert [n for n, _, _ in parts] == list(range(len(parts))) and (len(parts) == 1 or len(joined) > 1024)
        assert [s for _, s, _ in parts] == [sum(len(ids) for _, _, ids in parts[:k]) for k in range(len(parts))]
    assert not pieces
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = saved(stage(spark, empty, SF), name.replace(" ", "-"))
        assert empty.count() == 0
    odd = docs.limit(40).withColumns({"node": F.lit("x"), "th": F.lit(1.5), "row": F.lit("y"), "kept": F.lit(True), "id": F.lit(3)})
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = saved(stage(spark, odd, SF), name.replace(" ", "-"))
        assert after.columns == odd.columns
        odd = after
    assert corpus_pipeline.pack(spark, odd, SF).select("doc_id").distinct().count() == odd.count()
