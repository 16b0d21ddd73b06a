"""MinHash near-duplicate links by a chosen-path similarity join.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes), a MinHash signature and a digest of the set.
   Texts with equal digests form a class; its smallest doc_id stands for it from here on. Empty texts take no part.
2. Independent trees branch the classes: a node picks one or two signature positions by its own hash, and a class goes
   to the child named by its minimum there. At depth ``FIRST`` a pair of the bound's similarity is still together in a tree
   with probability 0.8, in one of ten trees with 0.9999998. Nodes of one class are dropped.
3. Every node at that depth compares its classes with its smallest one (a star), large nodes also with one picked by a
   hash; this joins most groups. Nodes of up to ``SMALL`` classes then compare exhaustively what is still apart.
4. Larger nodes whose classes are not all joined branch on, ``STEP`` levels at a time, with the mean of 1 / similarity
   children that keeps pairs of that similarity together in expectation; children that are small compare exhaustively, and
   children whose classes are joined already are done. A node that is still large and mixed at depth ``DEEPEST`` is truly
   dense; it compares what is apart on full sets, in blocks of about ``IN_BLOCK`` classes, a row for each pair of blocks, and
   keeps links that join the same classes as all of them do. Nothing is capped: no partner, candidate or node is dropped.
5. Candidates pass a size bound (exact) and a sketch of 128 bytes (a miss at the bound is 5 sigma off), and are then
   confirmed on the full sets, which only classes with candidates bring along.
6. Components by alternating large-star and small-star steps over the confirmed links.

Defined results: a null, empty or white-space text has an empty set and is linked with nothing; a text of fewer than
five words is one shingle; equal texts always share a component; a null doc_id keeps its row, without links; repeated
rows are kept and share their values; ties cannot occur, as the smallest doc_id stands for a component; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textvec as tv
from .shared import drop_table, materialise, tidy, without

SHINGLE = 5
POSITIONS = 128
TREES = 10
FIRST, STEP, DEEPEST = 2, 3, 5
SMALL = 24
#: Classes, and shingles on average, of a block when a large node compares exhaustively, block by block.
IN_BLOCK, SHINGLES_IN_BLOCK = 128, 20_000
#: Similarity of a link: the bound of op1's contract.
SIMILARITY = 0.85
#: Chance that a pair at the bound is together at depth FIRST of a tree.
TOGETHER = 0.824
#: Ids that are broadcast to find the texts of candidates; more are found by a shuffled join.
MAX_BROADCAST_IDS = 2_000_000
#: From so many rows on, a key is heavy: what belongs to it is broadcast, or dealt to ``PARTS`` tasks by a second key.
HEAVY, PARTS = 512, 64
#: Classes in groups that are broadcast with their components (some 32 bytes each); of more, only heavy ones are.
MAX_BROADCAST_GROUPS = 1_000_000
#: Rows of an Arrow batch of texts, of pairs of sets, and of pairs of blocks; columns of a product of incidence matrices.
TEXTS, SET_PAIRS, BLOCK_PAIRS, COLUMNS = 1024, 512, 8, 4096

_rng = np.random.default_rng(85)
_MULT = _rng.integers(0, 2**32, POSITIONS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, POSITIONS, dtype=np.uint64).astype(np.uint32)
_SEED = np.uint64(0xC0FFEE1234567)


@dataclass(frozen=True)
class Bound:
    """A similarity, in parts of 10,000, with all that follows from it."""

    parts: int

    @staticmethod
    def of(similarity: float) -> Bound:
        if not 0.5 <= similarity <= 1:
            raise ValueError("the trees are made for similarities from 0.5 to 1")
        return Bound(round(similarity * 10_000))

    @property
    def matches(self) -> int:
        """Equal sketch bytes that a candidate needs: the bound less five standard deviations."""
        s = self.parts / 10_000
        return math.floor(POSITIONS * s - 5 * math.sqrt(POSITIONS * s * (1 - s)))

    @property
    def second(self) -> float:
        """Chance of a second branch down to FIRST, so that pairs at the bound are together with TOGETHER."""
        s = self.parts / 10_000

        def together(second: float) -> float:
            x = 1.0
            for _ in range(FIRST):
                x = 1 - (1 - s * x) * (1 - second * s * x)
            return x

        return next((k / 100 for k in range(101) if together(k / 100) >= TOGETHER), 1.0)

    @property
    def second_below(self) -> float:
        """Chance of a second branch further down: 1 / similarity children in the mean."""
        return min(1.0, -(-100 * (10_000 - self.parts) // self.parts) / 100)

    def holds(self, part, whole):
        """Whether part / whole is at least the bound, exactly."""
        return 10_000 * part >= self.parts * whole


def block_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingle hashes of row i are hashes[bounds[i]:bounds[i + 1]]."""
    n = len(offsets) - 1
    low = tv.LOWER[raw]
    start, end, row = tv.words(low, offsets)
    word = tv.hashes(low, start, end)
    at, h = tv.windows(word, row, SHINGLE)
    owner = row[at]
    length = np.bincount(row, minlength=n)
    short = np.flatnonzero((length > 0) & (length < SHINGLE))
    if len(short):
        head = np.searchsorted(row, short)
        x = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = length[short] > k
            x[has] = tv.mix(x[has] * tv._BASE + word[head[has] + k])
        owner, h = np.concatenate((owner, short)), np.concatenate((h, x))
        order = np.argsort(owner, kind="stable")
        owner, h = owner[order], h[order]
    bounds = np.searchsorted(owner, np.arange(n + 1))
    for i in np.flatnonzero(np.diff(bounds) > 1):
        h[bounds[i] : bounds[i + 1]].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[fresh], np.searchsorted(owner[fresh], np.arange(n + 1))


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of POSITIONS hash functions over each non-empty set (rows of zeros for empty ones)."""
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), POSITIONS), np.uint32)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    key = (h >> np.uint64(32)).astype(np.uint32)
    value = np.empty_like(key)
    for t in range(POSITIONS):
        np.multiply(key, _MULT[t], out=value)
        value += _ADD[t]
        out[filled, t] = np.minimum.reduceat(value, bounds[:-1][filled])
    return out


def _children(node: np.ndarray, row: np.ndarray, values: np.ndarray, second: float) -> tuple[np.ndarray, np.ndarray]:
    """One level down: (child node, row); ``values[row]`` holds the signature of a node's member."""
    choice = tv.mix(node ^ _SEED)
    out = []
    for branch in range(2):
        x = tv.mix(choice + np.uint64(branch))
        go = np.ones(len(node), bool) if branch == 0 else (choice >> np.uint64(11)) < np.uint64(int(second * 2**53))
        place = (x[go] % np.uint64(POSITIONS)).astype(np.int64)
        value = values[row[go], place].astype(np.uint64)
        out.append((tv.mix(node[go] ^ tv.mix(value + np.uint64(1)) ^ tv.mix(place.astype(np.uint64) + np.uint64(1 << 40))), row[go]))
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _descend(node: np.ndarray, row: np.ndarray, values: np.ndarray, levels: int, second: float) -> tuple[np.ndarray, np.ndarray]:
    for _ in range(levels):
        node, row = _children(node, row, values, second)
    return node, row


def first_nodes(values: np.ndarray, second: float) -> tuple[np.ndarray, np.ndarray]:
    """(node, row) of every signature at depth FIRST of all trees."""
    n = len(values)
    roots = tv.mix(np.arange(1, TREES + 1, dtype=np.uint64) << np.uint64(32))
    return _descend(np.repeat(roots, n), np.tile(np.arange(n), TREES), values, FIRST, second)


def _fingerprints(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(bounds)
    filled = np.flatnonzero(sizes)
    out = []
    for salt in (0x1234567, 0xABCDEF1):
        total = np.zeros(len(sizes), np.uint64)
        if len(filled):
            total[filled] = np.add.reduceat(tv.mix(h ^ np.uint64(salt)), bounds[:-1][filled])
        out.append(total)
    return out[0], out[1]


def _lists(values: np.ndarray, row: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(row, kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].view(np.int64), pa.int64()))


def _blobs(matrix: np.ndarray) -> pa.Array:
    n, w = matrix.shape
    flat = np.ascontiguousarray(matrix)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, n * w + 1, w, dtype=np.int32)), pa.py_buffer(flat)])


def _matrix(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(len(column), POSITIONS)


def _describe(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, raw, offsets in tv.blocks(batch.column("text")):
            h, bounds = block_sets(raw, offsets)
            values = signatures(h, bounds)
            a, b = _fingerprints(h, bounds)
            node, row = first_nodes(values, bound.second)
            has = np.diff(bounds)[row] > 0
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), pa.array(np.diff(bounds), pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                _blobs(values.astype(np.uint8)), _lists(node[has], row[has], j - i),
            ], ["doc_id", "n_shingles", "fp_a", "fp_b", "sketch", "nodes"])


def _with(bound: Bound, batches: Callable) -> Callable:
    return tidy(functools.partial(batches, bound=bound))


def describe(docs: DataFrame, bound: Bound) -> DataFrame:
    """doc_id, n_shingles, set digest, sketch and first tree nodes of every whole text."""
    return docs.select("doc_id", "text").mapInArrow(
        _with(bound, _describe), "doc_id long, n_shingles long, fp_a long, fp_b long, sketch binary, nodes array<long>"
    )


_ROW = "node long, rep long, n long, sketch binary, comp long"


def _deeper(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    """The rows of nodes STEP levels on."""
    names = ["node", "rep", "n", "sketch", "comp"]
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            node = part.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            node, row = _descend(node, np.arange(part.num_rows), _matrix(part.column("sketch")), STEP, bound.second_below)
            rest = part.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), *(rest.column(c) for c in names[1:])], names)


def spread_join(rows: DataFrame, facts: DataFrame, key: str, size: str, unit: str) -> DataFrame:
    """``rows`` with ``facts`` (one row for each ``key``, with the number ``size`` of its rows) by an inner join that no key makes uneven.

    Heavy keys are few: at most one for every ``HEAVY`` rows. Up to ``MAX_BROADCAST_IDS`` of them are broadcast; of more, each
    is repeated for ``PARTS`` parts that the rows are dealt to by a hash of ``unit``.
    """
    heavy = materialise(facts.where(f"{size} > {HEAVY}"), "neardup-heavy", narrow=True)
    n = heavy.count()
    if not n:
        return rows.join(facts, key)
    light = facts.where(f"{size} <= {HEAVY}")
    if n <= MAX_BROADCAST_IDS:
        ids = F.broadcast(heavy.select(key))
        return rows.join(ids, key, "left_anti").join(light, key).unionByName(rows.join(F.broadcast(heavy), key))
    part = F.pmod(F.xxhash64(unit), F.lit(PARTS)).cast("int")
    every = heavy.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    dealt = rows.withColumn("_part", part)
    return dealt.join(light, key).drop("_part").unionByName(dealt.join(every, [key, "_part"]).drop("_part"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows (node, rep, n, sketch, comp) of nodes whose classes are of two components or more, with the node's size."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("comp").alias("_low"), F.max("comp").alias("_high")).where("_low < _high")
    sizes = materialise(sizes.select("node", "size"), "neardup-sizes", narrow=True)
    return spread_join(rows, sizes, "node", "size", "rep")


def _pairs_in_nodes(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    """Pairs of small nodes that are still apart; rows come sorted by node, so nodes are runs (one may span batches)."""
    rest: pa.Table | None = None

    def compare(table: pa.Table) -> pa.RecordBatch:
        node, comp = table.column("node").to_numpy(), table.column("comp").to_numpy()
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        sketch = _matrix(table.column("sketch"))
        found = []
        for gap in range(1, SMALL):
            a = np.flatnonzero(node[gap:] == node[:-gap])
            if not len(a):
                break
            b = a + gap
            big, small = np.maximum(n[a], n[b]), np.minimum(n[a], n[b])
            ok = (comp[a] != comp[b]) & bound.holds(small, big)
            a, b = a[ok], b[ok]
            ok = (sketch[a] == sketch[b]).sum(axis=1) >= bound.matches
            found.append(np.stack((np.minimum(rep[a[ok]], rep[b[ok]]), np.maximum(rep[a[ok]], rep[b[ok]]))))
        both = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        node = table.column("node").to_numpy()
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
        rest = table.slice(cut)
        if cut:
            yield compare(table.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield compare(rest)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds by row) of a list column, without a copy of the values."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.values
    if pa.types.is_binary(values.type):
        _, at, data = values.buffers()
        ends = np.frombuffer(at, np.int32)[values.offset :][: len(values) + 1].astype(np.int64)
        return np.frombuffer(data, np.uint8), ends[bounds]
    return values.to_numpy(), bounds


def _incidence(h: np.ndarray, owner: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    """n x len(columns): which of the shingles ``columns`` (sorted) each owner has."""
    out = np.zeros((n, len(columns)), np.float32)
    if len(columns):
        at = np.minimum(np.searchsorted(columns, h), len(columns) - 1)
        has = columns[at] == h
        out[owner[has], at[has]] = 1
    return out


def _forest(near: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of links that join what all links of ``near`` join, fewer than there are rows and columns; equal ``names`` are one."""
    up = list(range(len(names)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    left, right = names[: near.shape[0]].tolist(), names[near.shape[0] :].tolist()
    kept = []
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        for j in np.flatnonzero(near[i]).tolist():
            a, b = top(left[i]), top(right[j])
            if a != b:
                up[a] = b
                kept.append((i, j))
    at = np.array(kept, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1]


def _between_blocks(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    """Links between the two blocks of each row (or within one that meets itself) that join its classes that are apart.

    Intersections of all pairs are one product of the blocks' incidence matrices over the shingles that both hold.
    """
    for batch in batches:
        found = [np.zeros((2, 0), np.int64)]
        flat = {c: _flat(batch.column(c)) for c in batch.schema.names}
        for row in range(batch.num_rows):
            sides = []
            for side in "xy":
                rep, n, comp = (flat[f"{side}_{c}"][0][slice(*flat[f"{side}_{c}"][1][row : row + 2])] for c in ("rep", "n", "comp"))
                data, bounds = flat[f"{side}_shingles"]
                h = np.frombuffer(data[bounds[row] : bounds[row + 1]].tobytes(), np.uint64)
                sides.append((rep, n, comp, h, np.repeat(np.arange(len(rep)), n)))
            (ra, na, ca, ha, oa), (rb, nb, cb, hb, ob) = sides
            both = np.intersect1d(ha, hb)
            common = np.zeros((len(ra), len(rb)), np.int64)
            for at in range(0, len(both), COLUMNS):
                some = both[at : at + COLUMNS]
                common += np.rint(_incidence(ha, oa, len(ra), some) @ _incidence(hb, ob, len(rb), some).T).astype(np.int64)
            near = (ca[:, None] != cb[None, :]) & bound.holds(common, na[:, None] + nb[None, :] - common)
            i, j = _forest(near, np.unique(np.concatenate((ra, rb)), return_inverse=True)[1])
            found.append(np.stack((np.minimum(ra[i], rb[j]), np.maximum(ra[i], rb[j]))))
        links = np.unique(np.concatenate(found, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(links[0], pa.int64()), pa.array(links[1], pa.int64())], ["a", "b"])


def _dense_links(rows: DataFrame, docs: DataFrame, bound: Bound) -> DataFrame:
    """Links (a, b) of large nodes between classes that are apart, by pairs of blocks of full sets."""
    sets = sets_of(rows.select(F.col("rep").alias("doc_id")), docs)
    sizes = rows.groupBy("node").agg(F.greatest(F.ceil(F.count("*") / IN_BLOCK), F.ceil(F.sum("n") / SHINGLES_IN_BLOCK)).alias("k"), F.count("*").alias("size"))
    sizes = materialise(sizes, "neardup-sizes", narrow=True)
    placed = spread_join(rows.select("node", "rep", "n", "comp"), sizes, "node", "size", "rep").join(sets, "rep")
    members = F.collect_list(F.struct("rep", "n", "comp", "shingles"))
    blocks = placed.groupBy("node", "k", F.pmod(F.xxhash64("rep"), "k").alias("block")).agg(members.alias("x"))
    blocks = materialise(blocks, "neardup-blocks")
    parts = lambda side: [F.col(f"x.{c}").alias(f"{side}_{c}") for c in ("rep", "n", "comp", "shingles")]
    # Each pair of blocks is a key of its own half way: a task gets a block and, one after another, those that it meets.
    one = blocks.select("node", "block", F.explode(F.sequence("block", F.col("k") - 1)).alias("_other"), *parts("x"))
    two = blocks.select("node", F.col("block").alias("_other"), *parts("y"))
    met = one.join(two, ["node", "_other"]).drop("node", "block", "_other", "k")
    links = met.mapInArrow(_with(bound, _between_blocks), "a long, b long")
    links = materialise(links.distinct(), "neardup-links", narrow=True, batch=BLOCK_PAIRS)
    for table in (sets, blocks):
        drop_table(docs.sparkSession, table)
    return links


def _likely(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows whose sketches agree enough."""
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            same = (_matrix(part.column("sketch")) == _matrix(part.column("other"))).sum(axis=1) >= bound.matches
            yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(same)) for c in ("a", "b")], ["a", "b"])


def _fit(a: str, b: str, bound: Bound) -> F.Column:
    return F.expr(f"10000 * least({a}, {b}) >= {bound.parts} * greatest({a}, {b})")


@tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, raw, offsets in tv.blocks(batch.column("text")):
            h, bounds = block_sets(raw, offsets)
            data = [h[bounds[k] : bounds[k + 1]].tobytes() for k in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(data, pa.binary())], ["rep", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch], bound: Bound) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows whose full sets are as similar as the bound."""
    for batch in batches:
        left, right = batch.column("set_a"), batch.column("set_b")
        ok = []
        for x, y in zip(left, right):
            p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.concatenate((p, q))
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            ok.append(bound.holds(common, len(both) - common))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], ["a", "b"])


def sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """rep and shingles of the named documents; other texts are not shuffled while the ids are few enough to broadcast."""
    ids = materialise(ids.distinct(), "neardup-ids", narrow=True)
    small = ids.count() <= MAX_BROADCAST_IDS
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    sets = materialise(texts.mapInArrow(_sets, "rep long, shingles binary"), "neardup-sets", batch=TEXTS)
    drop_table(docs.sparkSession, ids)
    return sets


def confirmed(pairs: DataFrame, docs: DataFrame, bound: Bound) -> DataFrame:
    """The candidate pairs (a, b) that hold on full sets; only texts that a pair names are read into sets."""
    pairs = materialise(pairs.distinct(), "neardup-pairs", narrow=True)
    sets = sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs)
    # A pivot meets many: its pairs are dealt to tasks of about HEAVY, and its set is sent to each.
    tasks = F.ceil(F.count("*") / HEAVY).cast("int").alias("tasks")
    spread = {}
    for side in "ab":
        many = materialise(pairs.groupBy(side).agg(tasks).where("tasks > 1"), "neardup-many", narrow=True)
        spread[side] = F.broadcast(many) if many.count() <= MAX_BROADCAST_IDS else many
    with_sets = pairs
    for side, other in ("ba", "ab"):
        dealt = with_sets.join(spread[side], side, "left").withColumn("_part", F.pmod(F.xxhash64(other), F.coalesce("tasks", F.lit(1))).cast("int")).drop("tasks")
        own = sets.select(F.col("rep").alias(side), F.col("shingles").alias(f"set_{side}")).join(spread[side], side, "left")
        own = own.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("tasks", F.lit(1)) - 1))).drop("tasks")
        with_sets = dealt.join(own, [side, "_part"]).drop("_part")
    links = materialise(with_sets.select("a", "b", "set_a", "set_b").mapInArrow(_with(bound, _confirm), "a long, b long").distinct(), "neardup-links", narrow=True, batch=SET_PAIRS)
    for table in (pairs, sets):
        drop_table(docs.sparkSession, table)
    return links


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b), for every id that has a link."""
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        fresh = materialise(small, "neardup-edges", narrow=True)
        if seen is not None:
            drop_table(spark, edges)
        edges = fresh
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _named(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the component of their class, if any: heavy classes are broadcast, others joined by a shuffle."""
    heavy = groups.where(f"size > {HEAVY}").select("class", "component")
    first = rows.join(F.broadcast(heavy) if heavy.count() <= MAX_BROADCAST_GROUPS else heavy, "class", "left")
    rest = first.where("component IS NULL").drop("component").join(groups.where(f"size <= {HEAVY}").select("class", "component"), "class", "left")
    return first.where("component IS NOT NULL").unionByName(rest)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``; links are pairs of ``similarity`` or more."""
    spark, bound = docs.sparkSession, Bound.of(similarity)
    described = materialise(describe(docs, bound), "neardup-described", batch=TEXTS)
    sets = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch", "nodes")).alias("x")
    classes = sets.groupBy("fp_a", "fp_b").agg(first, F.count("*").alias("size"))
    classes = materialise(classes.select("fp_a", "fp_b", "size", "x.*"), "neardup-classes")
    reps = classes.select("rep", "n", "sketch", "nodes")

    slim = reps.select("rep", F.explode("nodes").alias("node"))
    picked = F.min_by("rep", F.xxhash64("node", "rep"))
    sizes = slim.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("pivot"), picked.alias("picked")).where("size > 1")
    sizes = materialise(sizes, "neardup-sizes", narrow=True)
    nodes = spread_join(slim, sizes, "node", "size", "rep").join(reps.select("rep", "n", "sketch"), "rep")
    nodes = materialise(nodes.select("node", "rep", "n", "sketch", "size", "pivot", "picked"), "neardup-nodes")

    def stars(rows: DataFrame, pivot: str) -> DataFrame:
        heads = rows.where(f"rep = {pivot}").select("node", "size", F.col("n").alias("m"), F.col("sketch").alias("other")).dropDuplicates(["node"])
        met = spread_join(rows.where(f"rep <> {pivot}").drop("size"), heads, "node", "size", "rep").where(_fit("n", "m", bound))
        return met.select(F.least(pivot, "rep").alias("a"), F.greatest(pivot, "rep").alias("b"), "sketch", "other").mapInArrow(_with(bound, _likely), "a long, b long")

    links = confirmed(stars(nodes, "pivot").union(stars(nodes.where(f"size > {SMALL}"), "picked")), docs, bound)
    joined = components(links).select(F.col("id").alias("rep"), "component")
    marked = nodes.join(joined, "rep", "left").select("node", "rep", "n", "sketch", F.coalesce("component", "rep").alias("comp"))
    marked = materialise(marked, "neardup-marked")  # _mixed reads its rows more than once
    level, depth, more = materialise(_mixed(marked), "neardup-mixed"), FIRST, None
    drop_table(spark, nodes)
    drop_table(spark, marked)
    while True:
        small = level.where(f"size <= {SMALL}").repartition("node").sortWithinPartitions("node")
        pairs = small.select("node", "rep", "n", "sketch", "comp").mapInArrow(_with(bound, _pairs_in_nodes), "a long, b long")
        more = pairs if more is None else more.union(pairs)
        large = level.where(f"size > {SMALL}").select("node", "rep", "n", "sketch", "comp")
        if depth >= DEEPEST or large.isEmpty():
            break
        deeper = materialise(large.mapInArrow(_with(bound, _deeper), _ROW), "neardup-deeper")
        level = materialise(_mixed(deeper), "neardup-mixed")
        drop_table(spark, deeper)
        depth += STEP
    links = links.union(confirmed(more, docs, bound))
    if not large.isEmpty():
        links = links.union(_dense_links(large, docs, bound))
    joined = components(links)

    # Only what is in a group of two texts or more needs the joins: a class of two rows, or one that is linked.
    linked = joined.select(F.col("id").alias("rep"), "component")
    groups = classes.join(linked, "rep", "left").where("size > 1 OR component IS NOT NULL").select("fp_a", "fp_b", "size", F.coalesce("component", "rep").alias("component"))
    groups = materialise(groups.withColumn("class", F.struct("fp_a", "fp_b")).select("class", "size", "component"), "neardup-groups", narrow=True)
    rows = described.select("doc_id", "n_shingles", F.struct("fp_a", "fp_b").alias("class"))
    usable = F.expr("n_shingles > 0 AND doc_id IS NOT NULL")
    named = rows.where(usable).join(F.broadcast(groups), "class", "left") if groups.count() <= MAX_BROADCAST_GROUPS else _named(rows.where(usable), groups)
    alone = rows.where(~usable).withColumn("component", F.lit(None).cast("long"))
    found = named.select("doc_id", "n_shingles", "component").unionByName(alone.select("doc_id", "n_shingles", "component"))
    found = found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group: the rows of ``docs`` whose doc_id is its component's smallest; rows repeated with id and text once."""
    lost = near_duplicates(docs, similarity).where("NOT kept").select("doc_id").distinct()
    left = without(docs, lost, ("doc_id",))
    twice = materialise(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "neardup-twice", narrow=True)
    if twice.isEmpty():
        return left
    once = left.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return without(left, twice, ("doc_id",)).unionByName(once)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All pairs that share a shingle, which a small table allows: what the trees find must be all of it.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS m FROM s GROUP BY doc_id
), c AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY m, n) AS rep FROM n
), r AS (
  SELECT s.doc_id, n, g FROM s JOIN c USING (doc_id) WHERE doc_id = rep
), l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM r a JOIN r b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT x AS a, x AS b FROM l UNION SELECT reach.a, l.y FROM reach JOIN l ON l.x = reach.b
), low AS (
  SELECT a, min(b) AS component FROM reach GROUP BY a
)
SELECT doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, coalesce(low.component, c.rep, doc_id) AS component_id, doc_id = coalesce(low.component, c.rep, doc_id) AS kept
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN low ON low.a = c.rep
"""
