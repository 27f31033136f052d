"""Token counts by a compiled finite-state transducer, for SentencePiece BPE models.

The vocabulary and its merge order are compiled into a deterministic weighted transducer over characters, state by
state as texts need them. Two neighbouring pieces can stand in a tokenization exactly if merging their joined text
gives the two back, so a text's tokenization is the one path of pairwise compatible pieces. A state holds, for each
vocabulary prefix that a path may be inside of, the piece before it and the tokens counted so far; the least of
these counts is emitted on the transition and the rest stays in the state (determinization with residual weights).
A word mark after another character resets the automaton, because no piece holds a mark behind another character.
So does a character after one of another group: characters that stand side by side in some piece are of one group
(letters of a script, signs). The stretch between two resets is remembered as one transition from start to start.

Each beginning of the piece being read has one piece before it, so a state holds one entry for each prefix length
that some longer piece still goes on from, and one for the finished piece. Whether two pieces can be neighbours is
read off the scores at which their parts at the border merge away.

Long texts are cut into chunks. A chunk becomes a map from the states it may be entered in to the state it is left in
and the tokens counted on the way. The first guess at its incoming state is the state after the BEFORE characters in
front of it, which is certain if they hold a reset and nearly always right if they do not. Then every state that the
chunk in front can be left in must be an entry of the map; chunks are run again from those that are not, until there
are none. States travel as text, the chunks' own texts do not. Complete maps compose associatively; they are combined
by a parallel prefix scan, runs of neighbouring chunks at a time. A text without any reset is as many chunks as any
other text of its length.

What a worker remembers (stretches, states with their arcs, pairs of pieces) is bounded by its bytes.

Defined cases: null and empty texts count 0 tokens; texts count whole; repeated rows are counted one by one; an
empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import Remembered, discard, saved

MARK = "▁"  # stands for a space in the model's pieces
CHUNK = 1 << 15  # characters
BEFORE = 256  # characters in front of a chunk that its incoming state is guessed from
RUN = 64  # neighbouring chunk maps composed at a time
GROUPS = 4  # largest groups of characters that are told from each other
LEVELS = 3  # RUN ** LEVELS chunks hold more characters than a string can
REMEMBERED = 96 << 20  # bytes of remembered stretches per worker
COMPILED = 192 << 20  # bytes of compiled states, arcs and pairs of pieces per worker, about


class Transducer:
    """Counts the tokens of stretches: runs of marks followed by other characters."""

    def __init__(self, pieces: dict[str, float]):
        """pieces: normal pieces and their merge scores (higher merges first)."""
        self.scores = pieces
        self.grows = {p[:n] for p in pieces for n in range(1, len(p))}
        self.singles = {p for p in pieces if len(p) == 1}
        self.fits: dict[tuple[str, str], bool] = {}
        self.borders: dict[str, tuple[list, list] | None] = {}  # at most one entry a piece
        self.pattern = _pattern(pieces)
        self.stretches = Remembered(self._stretch, REMEMBERED)
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self._forget()

    def merged(self, text: str, border: int = 0) -> list[str]:
        """Plain merges of a short text (at most two pieces long): best score first, leftmost on ties.

        None are left of the parts once a merge crosses `border` (characters from the left; 0: no border).
        """
        get, parts = self.scores.get, list(text)
        gains = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]  # of merging a part with the next
        while gains:
            best = max(gains)
            if best == _NEVER:
                break
            i = gains.index(best)
            if i < border:
                border -= 1  # now in parts
                if i == border:
                    return []
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i:
                gains[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
            if i < len(gains):
                gains[i] = get(parts[i] + parts[i + 1], _NEVER)
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging the joined text of two pieces gives the two back."""
        key = (a, b)
        found = self.fits.get(key)
        if found is None:
            found = self.fits[key] = a in self.reachable and b in self.reachable and self._apart(a, b)
            self.used += 120
        return found

    def _apart(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border of two reachable pieces.

        The parts at the border take turns to be merged away inwards, the better score first, the left one on ties; a
        pair across the border merges if it is better than both of these merges, or as good as the right one.
        """
        left, right = self._borders(a), self._borders(b)
        if left is None or right is None:
            return self.merged(a + b, len(a)) == [a, b]
        left, right, get, i, j = left[1], right[0], self.scores.get, 0, 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = get(x + y)
            if across is not None and across > x_ends and across >= y_ends:
                return False
            if x_ends >= y_ends:
                if x_ends == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _borders(self, piece: str) -> tuple[list, list] | None:
        """Parts that stand first, and last, while a reachable piece merges, each with the score it is merged away at.

        None if a merge is better than one before it: turns at a border do not follow from the scores then.
        """
        found = self.borders.get(piece, self)
        if found is not self:
            return found
        get, parts, first, last, before = self.scores.get, list(piece), [], [], math.inf
        while len(parts) > 1:
            gains = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
            best = max(gains)
            if best > before:
                self.borders[piece] = None
                return None
            before, i = best, gains.index(best)
            if i == 0:
                first.append((parts[0], best))
            if i == len(gains) - 1:
                last.append((parts[-1], best))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        found = self.borders[piece] = [*first, (piece, _NEVER)], [*last, (piece, _NEVER)]
        return found

    @functools.cached_property
    def reachable(self) -> frozenset[str]:
        """Pieces that merging their own text gives back."""
        return frozenset(p for p in self.scores if len(p) == 1 or self.merged(p) == [p])

    # A state is a tuple of (prefix being read, piece before it or "", residual count), known by a number: prefixes by
    # falling length, at last "", a finished piece: the next character begins a new one. State 0 is the start.

    def _forget(self) -> None:
        # in place: a run that is under way holds the list of arcs
        for kept in (self.states, self.numbers, self.arcs, self.fits):
            kept.clear()
        self.used = 0
        self._number(START)

    def _number(self, state: tuple) -> int:
        at = self.numbers.get(state)
        if at is None:
            at = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
            self.used += 200 + 80 * len(state)
        return at

    def _compile(self, at: int, c: str) -> tuple[int, int]:
        """The state after reading `c` in state `at`, and the tokens counted on the way; kept as an arc."""
        if c not in self.singles:  # falls back to its bytes, which no merge touches
            state, n = START, self.rest(at) + len(c.encode())
        else:
            out, done = [], None
            grows, whole, fits = self.grows, self.reachable, self.fits
            for prefix, last, n in self.states[at]:
                grown = prefix + c
                if done is None and grown in whole:
                    fit = not last or fits.get((last, grown))
                    if self.compatible(last, grown) if fit is None else fit:
                        done = ("", grown, n + 1)
                if grown in grows:
                    out.append((grown, last, n))
            out.append(done)
            n = min([m for _, _, m in out])
            state = tuple([(p, b, m - n) for p, b, m in out] if n else out)
        if self.used > COMPILED:
            self._forget()
            return self._number(state), n
        arc = self.arcs[at][c] = self._number(state), n
        self.used += 80
        return arc

    def rest(self, at: int) -> int:
        """Tokens still to be counted if the text ends in state `at`."""
        return self.states[at][-1][2]

    def read(self, at: int, text: str) -> tuple[int, int]:
        """The state after reading `text` in state `at`, and the tokens counted on the way."""
        count, arcs = 0, self.arcs
        for c in text:
            arc = arcs[at].get(c) or self._compile(at, c)
            at, n = arc
            count += n
        return at, count

    def run(self, text: str) -> int:
        """Tokens of `text`, read from the start state to an end."""
        at, count = self.read(0, text)
        return count + self.rest(at)

    def _stretch(self, text: str) -> int:
        return self.run(text.replace(" ", MARK))

    def count(self, text: str) -> int:
        """Tokens of a text between resets: each stretch a remembered transition from start to start.

        Marks are remembered as blanks: most stretches then take a byte a character.
        """
        return sum(map(self.stretches.__getitem__, self.pattern.findall(text.replace(MARK, " "))))

    def cross(self, entry: str, before: str, text: str) -> tuple[str, int]:
        """The state (as text) that a chunk entered in state `entry` is left in, and its tokens; `before`: text in front."""
        at, count = self._number(_state(entry)), 0
        first = _RESET.search(text)
        head = first.start() if first else len(text)
        if before and text[:1] == MARK and before[-1] != MARK:
            count, at = self.rest(at), 0
        at, n = self.read(at, text[:head])
        count += n
        if first:
            count += self.rest(at)
            tail = len(text[: text.rindex(MARK)].rstrip(MARK))  # the last reset
            count += self.count(text[head:tail])
            at, n = self.read(0, text[tail:])
            count += n
        return _name(self.states[at]), count

    def entry(self, before: str) -> str:
        """The state (as text) after `before`, read from its last reset, or else from its first character."""
        resets = [m.start() for m in _RESET.finditer(before)]
        return _name(self.states[self.read(0, before[resets[-1] if resets else 0 :])[0]])


def _pattern(pieces: dict[str, float]) -> re.Pattern:
    """Finds the stretches of a text with blanks for marks: blanks, then a run of one group or one lone character.

    A lone character has no neighbour but a mark in any piece. Groups beyond the largest count as one.
    """
    group: dict[str, set[str]] = {}
    words = [piece.lstrip(MARK) for piece in pieces]
    for a, b in {pair for word in words for pair in zip(word, word[1:])}:
        one, other = sorted((group.get(a, {a}), group.get(b, {b})), key=len)
        other |= one
        group.update(dict.fromkeys(one | {a, b}, other))
    groups = sorted({min(g): g for g in group.values()}.values(), key=lambda g: (-len(g), min(g)))
    runs = [sorted(g) for g in [*groups[:GROUPS], set().union(*groups[GROUPS:])] if g]
    return re.compile(" *+(?:" + "".join(f"[{re.escape(''.join(g))}]+|" for g in runs) + "[^ ])| ++", re.DOTALL)


def _name(state: tuple) -> str:
    return json.dumps(state, separators=(",", ":"))


def _state(name: str) -> tuple:
    return tuple(map(tuple, json.loads(name)))


START = (("", "", 0),)
_NEVER = -math.inf
_RESET = re.compile(f"(?<=[^{MARK}]){MARK}")

Map = dict[str, tuple[str, int]]  # by incoming state: outgoing state, tokens


def compose(a: Map, b: Map) -> Map:
    """The map of two neighbouring chunks, a before b; every state that a can be left in is an entry of b."""
    return {entry: (b[left][0], n + b[left][1]) for entry, (left, n) in a.items()}


@functools.cache
def transducer(path: str) -> Transducer:
    """The transducer of this worker process for a SentencePiece BPE model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    inner = [p for p in normal if MARK in p.lstrip(MARK)]
    if inner:
        raise ValueError(f"pieces with a word mark behind another character are not supported: {inner[:3]}")
    return Transducer(normal)


def _counts(to: Transducer, text: str) -> int:
    return to.count(" " + text) if text else 0


def count_tokens(docs: DataFrame, model_path: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id_column`, n_bytes (UTF-8) and n_tokens of every row, as the model's library counts them.

    The model must keep texts as they are (identity normalization) and put a mark before the text.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = transducer(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = [_counts(to, x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    short = rows.filter(F.length("text") <= CHUNK).mapInArrow(whole, f"id {kind}, n_bytes long, n_tokens long")
    long = _scan(rows.filter(F.length("text") > CHUNK), model_path, kind)
    return short.union(long).withColumnRenamed("id", id_column)


def _scan(rows: DataFrame, model_path: str, kind: str) -> DataFrame:
    """Counts texts of several chunks: a map per chunk, completed, then runs of neighbouring maps, level by level."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "id", "n_bytes", "chunk", "before", "text"]
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                text = one.column(3)[0].as_py()
                for first in range(0, len(text), 16 * CHUNK):
                    places = range(first, min(first + 16 * CHUNK, len(text)), CHUNK)
                    some = [one.column(i).take(pa.array([0] * len(places))) for i in range(3)]
                    before = [(MARK * (i <= BEFORE) + text[max(0, i - BEFORE) : i].replace(" ", MARK)) * (i > 0) for i in places]
                    told = [MARK * (i == 0) + text[i : i + CHUNK].replace(" ", MARK) for i in places]
                    yield pa.RecordBatch.from_arrays([*some, pa.array([i // CHUNK for i in places], pa.int32()), pa.array(before, pa.string()),
                                                      pa.array(told, pa.string())], names)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = transducer(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                before, texts = part.column(2).to_pylist(), part.column(3).to_pylist()
                entry = [e or (to.entry(b) if b else _name(START)) for e, b in zip(part.column(4).to_pylist(), before)]
                found = [to.cross(*x) for x in zip(entry, before, texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(entry, pa.string()), pa.array([x for x, _ in found], pa.string()),
                                                  pa.array([n for _, n in found], pa.int64())], ["row", "chunk", "entry", "left", "n"])

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = []
                for run in part.column(2).to_pylist():
                    maps = [{e["entry"]: (e["left"], e["n"]) for e in m["map"]} for m in run]
                    out.append([{"entry": e, "left": x, "n": n} for e, (x, n) in functools.reduce(compose, maps).items()])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, entries)], ["row", "chunk", "map"])

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, start = transducer(model_path), _name(START)
        for batch in batches:
            found = [next((e["left"], e["n"]) for e in m if e["entry"] == start) for m in batch.column(2).to_pylist()]
            counts = [n + to.rest(to._number(_state(left))) for left, n in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    entries = pa.list_(pa.struct([("entry", pa.string()), ("left", pa.string()), ("n", pa.int64())]))
    shape = "row long, chunk int, entry string, left string, n long"
    given = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "n_bytes", "text")
    cuts = given.mapInArrow(cut, f"row long, id {kind}, n_bytes long, chunk int, before string, text string").repartition("row", "chunk")
    cuts = saved(cuts, "chunks")
    chunks = cuts.select("row", "chunk", "before", "text")
    maps = [saved(chunks.withColumn("entry", F.lit(None).cast("string")).mapInArrow(crossed, shape), "maps")]
    while True:
        every = functools.reduce(DataFrame.union, maps)
        asked = every.select("row", (F.col("chunk") + 1).alias("chunk"), F.col("left").alias("entry")).distinct()
        missing = saved(chunks.join(asked.join(every, ["row", "chunk", "entry"], "left_anti"), ["row", "chunk"]).mapInArrow(crossed, shape), "maps")
        if missing.isEmpty():
            break
        maps.append(missing)
    mapped = every.groupBy("row", "chunk").agg(F.collect_list(F.struct("entry", "left", "n")).alias("map"))
    for _ in range(LEVELS):
        runs = mapped.groupBy("row", F.floor(F.col("chunk") / RUN).cast("int").alias("chunk")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("chunk").alias("at"), "map"))).alias("run"))
        mapped = runs.mapInArrow(composed, "row long, chunk int, map array<struct<entry: string, left: string, n: long>>")
    heads = cuts.filter("chunk = 0").select("row", "id", "n_bytes")
    out = saved(heads.join(mapped.select("row", "map"), "row").select("id", "n_bytes", "map").mapInArrow(ended, f"id {kind}, n_bytes long, n_tokens long"), "counts")
    discard(cuts, missing, *maps)
    return out
