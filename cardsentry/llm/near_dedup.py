"""Near-duplicate classes by MinHash bands and sequential Bayesian verification.

1. A text (A-Z lower-cased) becomes its set of five-word shingles; texts with equal sets are one node, so copies are
   counted and never compared. A node's name is its least row (id and hash of the text) in an order-keeping binary
   form, so that the least node of a class tells the class's least id.
2. Nodes get a MinHash signature. Nodes that agree on a whole band meet in a bucket; a pair at the threshold shares no
   band with probability (1 - 0.85^ROWS)^BANDS, below 1e-7.
3. A candidate pair's signatures are compared batch by batch. After each batch the posterior (uniform prior) that the
   similarity reaches the threshold is bounded; a pair below the miss probability is pruned. Survivors are verified
   exactly on their whole sets.
4. Only links between different classes matter. In every bucket that holds several classes, LEADERS members are
   elected: the one that meets most others in all of its buckets, and some by hashes. In buckets of up to LEADERS + 1
   members each is a candidate of all leaders, which covers all pairs. In larger ones a node is a candidate of one
   leader per election, the first of all its buckets by the same order, so that the members of a large group choose
   the same few; the verified links merge classes. STAR_ROUNDS such rounds cost a few
   pairs a node, whatever the buckets' sizes, and most large buckets end as one class.
5. The rest is exact: in larger buckets that still hold several classes, members outside the first leader's class are
   compared with each other and with that class, in blocks of BLOCK members, and pairs of one class are skipped.
   A task verifies its surviving pairs at once and tells one link between two classes only.

Candidates are verified along stars: the candidates of one node stream past its set (or signature), dealt by a hash
to tasks of about FAN each; a task holds one set and what streams by, however long the texts are or however many
candidates a node has.

Words are runs of characters other than space and the controls 9 to 13. Shingles are compared as 64-bit hashes.

Defined cases: null and empty texts, and texts without words, have no shingles and link to nothing; a text of one to
four words is one shingle, so only its copies link to it; rows that repeat an id, with the same text or another, are
rows of their own; null ids come after all others, and a class of null ids only has component null; kept compares
nulls as equal; an empty table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cardsentry.llm.common import discard, mixed, saved, shingles, sieved, word_hashes
from cardsentry.llm.components import components

WORDS = 5
THRESHOLD = 85  # hundredths
BANDS = 32
ROWS = 5
BATCH = 32  # signature values compared at a time
MISS = 1e-9  # posterior probability below which a pair is pruned
LEADERS = 3  # of a bucket and star round
STAR_ROUNDS = 2
BLOCK = 4096  # members of a block in the exact rest
BLOCK_SHINGLES = 1 << 20  # and shingles of them: 8 MiB
FAN = 256  # candidates of a node that one task compares with it, about
HOT = 10_000  # at most so many classes or nodes hold a 1/HOT share of the rows each: these are looked up by broadcast
_VALUES = BANDS * ROWS

_rng = np.random.default_rng(19991231)
_FACTORS = _rng.integers(0, 1 << 32, _VALUES, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, _VALUES, dtype=np.uint32)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text, A-Z lower-cased."""
    return np.unique(shingles(word_hashes(data.translate(_LOWER)), WORDS))


def signature(members: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of a non-empty set."""
    low = mixed(members).astype(np.uint32)
    least = np.full(_VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        least = np.minimum(least, (low[at : at + 512, None] * _FACTORS + _SHIFTS).min(axis=0))
    return (least >> np.uint32(16)).astype(np.uint16)


@functools.cache
def least_equal(threshold: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(n, m) by rising n: with fewer than m equal values among the first n, the posterior is below `miss`.

    With a uniform prior the similarity after m of n equal values is Beta(m + 1, n - m + 1) distributed, and its
    chance to reach t is that of at most m successes in n + 1 trials of probability t.
    """
    t, out = threshold / 100, []
    for n in range(BATCH, _VALUES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def sequentially(left: np.ndarray, right: np.ndarray, threshold: int, miss: float) -> np.ndarray:
    """Rows of two aligned signature tables (or of one signature and a table) that no batch prunes."""
    n_rows = max(len(left), len(right))
    alive, equal, at = np.arange(n_rows), np.zeros(n_rows, np.int16), 0
    for n, m in least_equal(threshold, miss):
        a = left[:, at:n] if len(left) == 1 else left[alive, at:n]
        equal = equal + (a == right[alive, at:n]).sum(axis=1, dtype=np.int16)
        keep = equal >= m
        alive, equal, at = alive[keep], equal[keep], n
        if not len(alive):
            break
    return alive


def is_linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether two sorted sets reach the threshold, exactly."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    short, long = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(long, short)
    shared = int((long[np.minimum(at, len(long) - 1)] == short).sum())
    return 100 * shared >= threshold * (len(a) + len(b) - shared)


def node_name(id_column: Column, th: Column) -> Column:
    """16 bytes (17 for null ids) that sort like (id, th), null ids last."""
    def eight(x):
        # the sign bit flipped: two's complement then sorts as unsigned bytes
        return F.unhex(F.lpad(F.hex(x.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    return F.concat(F.coalesce(eight(id_column), F.unhex(F.lit("FF" * 9))), eight(th))


def id_of(name: Column) -> Column:
    """The id in a node's name; null if it has none. Real ids of eight FF bytes are told apart by the length."""
    whole = F.conv(F.hex(F.substring(name, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.when(F.octet_length(name) == 16, whole)


def rows_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, th (hash of the text), sh (16-byte digest of the shingle set, null without shingles), size, signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                digest, size, signs = [], [], []
                for data in part.column(2).to_pylist():
                    members = shingle_set(data)
                    size.append(len(members))
                    digest.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None)
                    signs.append(signature(members).tobytes() if len(members) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(digest, pa.binary()), pa.array(size, pa.int64()),
                                                  pa.array(signs, pa.binary())], ["id", "th", "sh", "size", "signs"])

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("data"))
    return rows.mapInArrow(run, "id long, th long, sh binary, size long, signs binary")


def along(edges: DataFrame, items: DataFrame, test: Callable[[bytes, list[bytes]], list[int]]) -> DataFrame:
    """Edges (a, b) whose items (node, data) pass `test`, which tells the places of the members that b's item keeps.

    The members of a star stream past the item of its centre b, FAN of them to a task; edges must be distinct and saved.
    """
    size = edges.groupBy("b").agg(F.ceil(F.count("*") / FAN).cast("long").alias("fans")).withColumnRenamed("b", "centre")
    # null-safe joins shuffle both sides anew, so that a star of very many members can be split among tasks
    dealt = edges.join(size, F.col("b").eqNullSafe(F.col("centre"))).select("a", "b", F.pmod(F.xxhash64("a"), F.col("fans")).alias("fan"))
    members = dealt.join(items, dealt["a"] == items["node"]).select("b", "fan", F.lit(1).alias("kind"), "a", "data")
    centres = size.withColumn("fan", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fans") - 1))).join(items, F.col("centre") == items["node"])
    centres = centres.select(F.col("centre").alias("b"), "fan", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("a"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = data = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                b, kind, a, given = (part.column(i).to_pylist() for i in (0, 2, 3, 4))
                out_a, out_b, first = [], [], 0
                while first < len(b):
                    if kind[first] == 0:
                        centre, data, first = b[first], given[first], first + 1
                        continue
                    last = first
                    while last < len(b) and kind[last] == 1:
                        last += 1
                    for i in test(data, given[first:last]):
                        out_a.append(a[first + i]), out_b.append(centre)
                    first = last
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], ["a", "b"])

    together = centres.union(members).repartition("b", "fan").sortWithinPartitions("b", "fan", "kind")
    return together.mapInArrow(run, "a binary, b binary")


def pruned(edges: DataFrame, signs: DataFrame, threshold: int, miss: float) -> DataFrame:
    def test(centre: bytes, members: list[bytes]) -> list[int]:
        table = np.frombuffer(b"".join(members), np.uint16).reshape(len(members), _VALUES)
        return sequentially(np.frombuffer(centre, np.uint16)[None, :], table, threshold, miss).tolist()
    return along(edges, signs, test)


def verified(edges: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    def test(centre: bytes, members: list[bytes]) -> list[int]:
        own = np.frombuffer(centre, np.uint64)
        return [i for i, m in enumerate(members) if is_linked(own, np.frombuffer(m, np.uint64), threshold)]
    return along(edges, sets, test)


def buckets_of(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node, size, n, fame) of the buckets with several nodes: n of them; fame sums a node's n."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(F.xxhash64(F.substring("data", i * width + 1, F.lit(width)), i).alias("bucket"), i.alias("band")))
    rows = nodes.select("node", "size", F.explode(keys).alias("k")).select("k.bucket", "k.band", "node", "size")
    several = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").withColumnRenamed("bucket", "met")
    # at most BANDS rows a node
    fame = F.sum("n").over(Window.partitionBy("node"))
    return rows.join(several, F.col("bucket").eqNullSafe(F.col("met"))).drop("met").withColumn("fame", fame)


def divided(buckets: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Bucket rows with their class (column `class`)."""
    if classes is None:
        return buckets.withColumn("class", F.col("node"))
    return buckets.join(classes.select(F.col("vertex").alias("node"), "component"), "node", "left").select(
        "bucket", "band", "node", "size", "n", "fame", F.coalesce("component", "node").alias("class"))


def star_candidates(rows: DataFrame, salt: int) -> DataFrame:
    """Distinct (a, b): members and leaders of other classes, in buckets that hold several classes."""
    one = F.struct("node", "class", "fame")
    # the most famous member is likely the middle of a group of near copies
    rank = [F.struct(-F.col("fame"), F.xxhash64("node", F.lit(salt))), *(F.xxhash64("node", F.lit(salt + i)) for i in range(1, LEADERS))]
    leaders = F.array(*(F.min_by(one, by) for by in rank))
    elected = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), leaders.alias("leaders"))
    elected = elected.filter("low != high").select(F.col("bucket").alias("own"), "leaders")
    # the null-safe join shuffles both sides anew, so that a bucket of very many members can be split among tasks
    met = rows.join(elected, F.col("bucket").eqNullSafe(F.col("own"))).select("n", "node", "class", F.posexplode("leaders").alias("turn", "l"))
    met = met.filter(F.col("class") != F.col("l.class")).select("n", "turn", "node", F.col("l.node").alias("leader"), F.col("l.fame").alias("fame"))
    small = F.col("n") <= LEADERS + 1
    few = met.filter(small).select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
    chosen = F.min_by("leader", F.struct(F.when(F.col("turn") == 0, -F.col("fame")).otherwise(0), F.xxhash64("leader", F.col("turn") + salt)))
    many = met.filter(~small).groupBy("node", "turn").agg(chosen.alias("b")).select(F.col("node").alias("a"), "b")
    return few.union(many).distinct()


def rest_links(rows: DataFrame, signs: DataFrame, sets: DataFrame, threshold: int, miss: float) -> DataFrame:
    """Verified pairs (a, b) that link different classes, from all pairs of the buckets that hold several classes.

    Members of the class of the bucket's first leader form one side, all others the other one. Pairs across the
    sides, and pairs of others, meet in pairs of blocks; a task holds one block and streams the other past it.
    """
    first = F.min_by("class", F.xxhash64("node"))
    elected = rows.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), first.alias("main"))
    elected = elected.filter("low != high").select(F.col("bucket").alias("own"), "main")
    met = rows.join(elected, F.col("bucket").eqNullSafe(F.col("own"))).drop("own").withColumn("aside", F.col("class") != F.col("main"))
    # blocks of about BLOCK members and BLOCK_SHINGLES shingles at most; one larger set is a block by itself
    blocks = lambda of: F.ceil(F.greatest(F.count_if(of) / BLOCK, F.sum(F.when(of, F.col("size"))) / BLOCK_SHINGLES)).cast("int")
    counts = met.groupBy("bucket").agg(blocks(F.col("aside")).alias("rb"), blocks(~F.col("aside")).alias("sb")).withColumnRenamed("bucket", "own")
    met = met.join(counts, F.col("bucket").eqNullSafe(F.col("own"))).drop("own")
    at = F.pmod(F.xxhash64("node"), F.when(F.col("aside"), F.col("rb")).otherwise(F.col("sb")).cast("long")).cast("int")
    met = met.withColumn("at", at)
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda main, lo, hi, streams: F.struct(F.lit(main).alias("with_main"), lo.alias("lo"), hi.alias("hi"), streams.alias("streams"))
    # others are held and the main class streams; of two blocks of others the lower one is held
    from_main = F.transform(upto("rb"), lambda j: place(True, j, F.col("at"), F.lit(True)))
    from_other = F.transform(upto("sb"), lambda i: place(True, F.col("at"), i, F.lit(False)))
    inner = F.transform(upto("rb"), lambda j: place(False, F.least("at", j), F.greatest("at", j), F.col("at") > j))
    dealt = met.withColumn("p", F.explode(F.when(F.col("aside"), F.concat(from_other, inner)).otherwise(from_main)))
    keys = ["bucket", "with_main", "lo", "hi"]
    dealt = dealt.select("bucket", "p.with_main", "p.lo", "p.hi", "p.streams", "band", "node", "class")
    dealt = dealt.join(signs.withColumnRenamed("data", "signs"), "node").join(sets, "node").select(*keys, "streams", "band", "node", "class", "signs", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                out = []
                for row in zip(*(part.column(i).to_pylist() for i in range(10))):
                    if held is None or held.key != row[:4]:
                        held = _Held(row[:4], row[5], threshold, miss)
                    _, with_main, lo, hi, streams, _, node, kind, signs_of, data = row
                    if streams or (not with_main and lo == hi):
                        out.extend(held.links(node, kind, signs_of, data))
                    if not streams:
                        held.add(node, kind, signs_of, data)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "streams").mapInArrow(run, "a binary, b binary").distinct()


class _Held:
    """Members of a block, compared with those that stream past; classes that a link joins count as one from then on."""

    def __init__(self, key: tuple, band: int, threshold: int, miss: float):
        self.key, self.band, self.threshold, self.miss = key, band, threshold, miss
        self.names: list[bytes] = []
        self.classes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.signs = np.empty((16, _VALUES), np.uint16)
        self.numbers: dict[bytes, int] = {}
        self.root: list[int] = []

    def _class(self, kind: bytes) -> int:
        at = self.numbers.setdefault(kind, len(self.root))
        if at == len(self.root):
            self.root.append(at)
        return at

    def _top(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def add(self, node: bytes, kind: bytes, signs: bytes, data: bytes) -> None:
        n = len(self.names)
        if n == len(self.signs):
            self.signs = np.concatenate([self.signs, np.empty_like(self.signs)])
        self.signs[n] = np.frombuffer(signs, np.uint16)
        self.names.append(node), self.classes.append(self._class(kind)), self.sets.append(np.frombuffer(data, np.uint64))

    def links(self, node: bytes, kind: bytes, signs: bytes, data: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Pairs of `node` and held members of other classes; one of each class is enough."""
        if not self.names:
            return
        own, sign, mine = self._class(kind), np.frombuffer(signs, np.uint16), np.frombuffer(data, np.uint64)
        table = self.signs[: len(self.names)]
        alive = sequentially(sign[None, :], table, self.threshold, self.miss)
        # the pair belongs to the first band on which it agrees
        agrees = (table[alive] == sign).reshape(len(alive), BANDS, ROWS).all(axis=2)
        for j in alive[agrees.argmax(axis=1) == self.band].tolist():
            x, y = self._top(own), self._top(self.classes[j])
            if x != y and is_linked(mine, self.sets[j], self.threshold):
                self.root[max(x, y)] = min(x, y)
                yield node, self.names[j]


def looked_up(rows: DataFrame, key: str, table: DataFrame, value: str, size: str, total: int) -> DataFrame:
    """Rows with `value` of the table's row with their key (null if none); table: key, value, and rows per key (size).

    Keys with more than total / HOT rows are at most HOT, so these are broadcast; no other key's rows are many.
    """
    hot = saved(table.filter(F.col(size) * HOT > total).select(F.col(key).alias("hot_key"), F.col(value).alias("hot_value")), "hot")
    mild = table.filter(F.col(size) * HOT <= total).select(F.col(key).alias("own"), value)
    found = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    rest = found.filter("hot_key IS NULL")
    common = found.filter("hot_key IS NOT NULL").select(*rows.columns, F.col("hot_value").alias(value))
    # rows without a key stay where they are: in a join they would all meet in one task
    bare = rest.filter(F.col(key).isNull()).select(*rows.columns, F.col("hot_value").alias(value))
    asked = rest.filter(F.col(key).isNotNull()).select(*rows.columns)
    return common.union(bare).union(asked.join(mild, F.col(key) == F.col("own"), "left").select(*rows.columns, value))


def near_duplicates(docs: DataFrame, *, threshold: int = THRESHOLD, miss: float = MISS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: its id, n_shingles, component_id (least id of its class) and kept (whether it has that id)."""
    rows = saved(rows_of(docs, id_column, text_column), "rows")
    nodes = rows.filter("sh IS NOT NULL").groupBy("sh").agg(
        F.min(node_name(F.col("id"), F.col("th"))).alias("node"), F.count("*").alias("copies"), F.any_value("size").alias("size"), F.any_value("signs").alias("data"))
    nodes = saved(nodes, "nodes")
    buckets = saved(buckets_of(nodes), "buckets")
    wanted = saved(buckets.select("node").distinct(), "wanted")
    signs = nodes.select("node", "data")

    # whole sets of the nodes that have candidates, from the one text that stands for each
    text = F.coalesce(F.col(text_column), F.lit(""))
    texts = docs.select(node_name(F.col(id_column).cast("long"), F.xxhash64(text)).alias("node"), text.cast("binary").alias("data"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                made = [shingle_set(x).tobytes() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], ["node", "data"])

    found = sieved(texts, wanted, ["node"]).join(wanted, "node").dropDuplicates(["node"])
    sets = saved(found.mapInArrow(sets_of, "node binary, data binary"), "sets")
    discard(wanted)

    links, classes, used = None, None, []
    for turn in range(STAR_ROUNDS + 1):
        # a first star round covers all pairs of small buckets
        labelled = saved(divided(buckets.filter(F.col("n") > LEADERS + 1) if turn else buckets, classes), "labelled")
        if turn < STAR_ROUNDS:
            met = saved(star_candidates(labelled, turn * LEADERS), "met")
            candidates = saved(pruned(met, signs, threshold, miss), "candidates")
            fresh = saved(verified(candidates, sets, threshold), "links")
            discard(met, candidates)
        else:
            fresh = saved(rest_links(labelled, signs, sets, threshold, miss), "links")
        discard(labelled)
        used.append(fresh)
        links = fresh if links is None else links.union(fresh)
        if not fresh.isEmpty():
            classes = saved(components(links, "a", "b"), "classes")
            used.append(classes)
    discard(buckets, sets)

    # a class's name tells its least id; nodes on their own need no row
    named = nodes.select("sh", "node", "copies")
    if classes is not None:
        named = named.join(classes.withColumnRenamed("vertex", "node"), "node", "left")
    else:
        named = named.withColumn("component", F.lit(None).cast("binary"))
    named = named.filter("copies > 1 OR component IS NOT NULL")
    told = saved(named.select("sh", id_of(F.coalesce("component", "node")).alias("component_id"), F.lit(True).alias("told"), "copies")
                 .select("sh", F.struct("component_id", "told").alias("of"), "copies"), "told")
    discard(*used, nodes)
    given = looked_up(rows.select("id", "size", "sh"), "sh", told, "of", "copies", rows.count())
    component = F.when(F.col("of.told"), F.col("of.component_id")).otherwise(F.col("id"))
    return given.select(F.col("id").alias(id_column), F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
