"""Quality rules as a short-circuit cascade, ordered by rejection per cost (DataFrame functions only).

`measure` adds the base columns, `order_rules` times each rule and counts its rejections on a bounded sample,
`apply_rules` evaluates the rules lazily in that order (a CASE whose later branches are not reached once a rule
rejects). The order never changes a verdict, only what it costs.

Defined cases: null text counts as a text without words and fails the base rule; empty texts too; texts of any
length are processed whole; repeated rows are judged one by one; empty tables give empty results; other columns
of the input are carried in a struct, so that their names cannot clash.
"""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that part words, symbols that count, and the base limits.
PARTING = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
NO_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclasses.dataclass(frozen=True)
class Rule:
    """A named condition that rejects a document; it may use the base columns and `text`."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    """Rules after the base rule; thresholds leave ordinary prose of any language alone."""
    text, words = F.col("text"), F.col("n_words")
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))
    shouts = F.length(text) - F.length(F.translate(text, "!", ""))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("duplicate_lines", (F.col("n_dup_lines") >= 5) & (F.col("n_dup_lines") * 2 > F.size(F.split(text, "\n")))),
        Rule("word_length", (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 20)),
        Rule("exclamations", shouts * 10 > words * 3),
        Rule("capitals", capitals * 2 > F.length(text)),
    ]


def _let(value: Column, then) -> Column:
    """`then(value)` with `value` evaluated once: bound as the variable of a lambda."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _repeated(words: Column) -> Column:
    """Number of words that lie in a window of WINDOW words found twice or more."""

    def covered(starts: Column) -> Column:
        # each marked start covers up to the next marked start, at most a whole window
        n = F.size(starts)
        gaps = F.zip_with(F.slice(starts, 1, n - 1), F.slice(starts, 2, n - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.when(n < 2, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(0), lambda s, g: s + g) + WINDOW)

    def marked(windows: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(windows) - 1)
        ordered = F.array_sort(F.zip_with(windows, places, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def pick(rows: Column) -> Column:
            n = F.size(rows)
            beside = F.zip_with(F.slice(rows, 1, n - 1), F.slice(rows, 2, n - 1), lambda a, b: F.when(
                a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
            return F.array_sort(F.array_distinct(F.flatten(beside)))

        return _let(_let(ordered, pick), covered)

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(marked(windows))

    def doubled(parts: Column, k: int) -> Column:
        # the hash of 2k words from those of the k words at each end
        n = F.size(parts) - k
        return F.zip_with(F.slice(parts, 1, n), F.slice(parts, k + 1, n), lambda x, y: F.xxhash64(x, y))

    windows = _let(_let(doubled(words, 1), lambda x: doubled(x, 2)), lambda x: doubled(x, 4))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(_let(windows, of_windows))


def measure(docs: DataFrame) -> DataFrame:
    """Adds the base columns (long) and `base_failed` to rows with a `text`; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.btrim(s, F.lit(SPACES))) > 0)
    words = F.array_remove(F.split(text, PARTING), "")
    stats = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w).cast("long").alias("n_repeat_words")))
    dups = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    out = docs.withColumns({
        "text": text,
        "_stats": stats,
        "n_symbols": F.length(F.regexp_replace(text, NO_SYMBOLS, "")).cast("long"),
        "n_dup_lines": dups,
    })
    out = out.withColumns({k: F.col(f"_stats.{k}") for k in ("n_words", "word_chars", "n_repeat_words")}).drop("_stats")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return out.withColumn("base_failed", failed)


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = 512) -> list[Rule]:
    """`rules` by falling rejections per second, both measured on at most `sample_rows` rows of `docs`.

    The sample only sets the order. A rule's cost is the time of a job that evaluates it over the persisted
    sample, less that of a job that evaluates nothing.
    """
    sample = measure(docs.select("text").limit(sample_rows)).persist()
    try:
        sample.count()

        def timed(rejects: Column) -> tuple[float, int]:
            began = time.perf_counter()
            n = sample.agg(F.count_if(rejects)).first()[0]
            return time.perf_counter() - began, n

        idle = min(timed(F.lit(False))[0] for _ in range(2))
        worth = {}
        for rule in rules:
            took, rejected = timed(rule.rejects)
            worth[rule.name] = (rejected + 0.5) / max(took - idle, 1e-3)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda r: -worth[r.name])


def apply_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, *, ordered: bool = False,
                keep_columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of `docs`: `keep_columns`, the base columns, base_failed, rejected_by and kept.

    `rejected_by` is the first rule in cascade order that rejects ("base" for the base rule), null if kept.
    """
    rules = list(default_rules() if rules is None else rules)
    if not ordered:
        rules = order_rules(docs, rules)
    judged = _judged(docs, rules, keep_columns)
    return judged.select("given.*", *BASE, "base_failed", "rejected_by", F.col("rejected_by").isNull().alias("kept"))


def keep(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of `docs` that no rule rejects, as they are."""
    rules = order_rules(docs, list(default_rules() if rules is None else rules))
    return _judged(docs, rules, docs.columns).filter("rejected_by IS NULL").select("given.*")


def _judged(docs: DataFrame, rules: Sequence[Rule], carried: Sequence[str]) -> DataFrame:
    """`carried` columns as the struct given (so that no name clashes), the base columns and rejected_by."""
    source = docs.select(F.struct(*carried).alias("given"), "text")
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return measure(source).withColumn("rejected_by", verdict)
