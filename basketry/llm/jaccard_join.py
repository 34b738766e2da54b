"""N-gram Jaccard join: an exact similarity self-join of documents' shingle sets by a prefix-tree.

Shingles have one global order, by how common they are. Two sets with the wanted similarity share a shingle among the
``n - ceil(t n) + 1`` rarest of each, so documents meet under the shingles of these prefixes only. All documents that meet
under some shingle are also members of the block of the first document that is there; so each similar pair is in a block
together; members without another one that could be similar, by its size, go. A block's sets, common shingles first, are stored in a path-compressed trie. A set's overlap with all paths is
found from the root down, once for each node, however many sets lie below; a subtree is left once the remaining lengths
cannot bring the overlap needed. Tasks keep what is linked already, and give the links that connect something new only.

Similarity 0.75 is tested in whole numbers: 100 * intersection >= 75 * union, that is 7 * intersection >= 3 * (sizes' sum).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import bloom
from basketry.llm.components import components
from basketry.llm.store import dropped, kept
from basketry.llm.words import LOWER, U, Trimmed, Words, bounded_batches, chunks, mixed, signed, windows

SHINGLE, HOT, MOST_HOT, BLOCK, PART = 5, 6, 1 << 21, 4096, 1 << 21
BATCH = 4 << 20  # bytes of texts that a task holds at once, with a multiple of it in shingles
TOP = U(1 << 63)
NONE = np.zeros(0, U)


def _row_sets(w: Words, size: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes (63 bits); a row of fewer words has its whole sequence as one."""
    grams = windows(w.hashes, size)
    for short in range(1, size):
        at = w.bounds[:-1][np.diff(w.bounds) == short]
        if len(at):
            grams[at] = mixed(windows(w.hashes, short)[at] + U(short))
    grams >>= U(1)
    for r in range(w.rows):
        a, z = w.bounds[r], w.bounds[r + 1]
        part = np.sort(grams[a : max(z - size + 1, min(a + 1, z))])
        yield part[np.r_[True, part[1:] != part[:-1]]] if len(part) else part


def _prefix(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1 if n else 0


def _classes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for w in chunks(batch.column("text"), LOWER):
            for s in _row_sets(w, size):
                out.append((len(s), *signed(np.array([mixed(s).sum(dtype=U), mixed(s + U(7)).sum(dtype=U)], U)).tolist()))
        n, one, two = (pa.array([x[i] for x in out], pa.int64()) for i in range(3))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, one, two], ["doc_id", "n", "h1", "h2"])


def _members(batch: pa.RecordBatch, wanted: np.ndarray) -> pa.RecordBatch:
    return batch.filter(pa.array(bloom.maybe(wanted, batch.column("doc_id").to_numpy(zero_copy_only=False))))


def _prefix_counts(batches: Iterator[pa.RecordBatch], size: int, wanted: Broadcast, common: Broadcast | None = None) -> Iterator[pa.RecordBatch]:
    """How often shingles are in a prefix, in the order of their hashes or the global order."""
    hot, rank = common.value if common else (NONE, NONE)
    for batch in batches:
        firsts = [_ordered(s, hot, rank)[: _prefix(len(s))] for w in chunks(_members(batch, wanted.value).column("text"), LOWER) for s in _row_sets(w, size)]
        tokens, counts = np.unique(np.concatenate(firsts or [np.zeros(0, U)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(tokens)), pa.array(counts)], ["token", "n"])


def _ordered(s: np.ndarray, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A set in the global order: common shingles by their rank, behind all others."""
    if not len(hot) or not len(s):
        return s
    at = np.searchsorted(hot, s)
    at[at == len(hot)] = 0
    is_hot = hot[at] == s
    return np.concatenate([s[~is_hot], np.sort(rank[at[is_hot]]) | TOP])


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, wanted: Broadcast, common: Broadcast, again: Broadcast) -> Iterator[pa.RecordBatch]:
    hot, rank = common.value
    for batch in batches:
        batch = _members(batch, wanted.value)
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        tokens, lengths, sizes = [], [], []
        for w in chunks(batch.column("text"), LOWER):
            for s in _row_sets(w, size):
                first = _ordered(s, hot, rank)[: _prefix(len(s))]
                tokens.append(first)
                lengths.append(len(first))
                sizes.append(len(s))
        token = np.concatenate(tokens) if tokens else NONE
        keep = bloom.maybe(again.value, signed(token))
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (signed(token), np.repeat(ids, lengths), np.repeat(np.array(sizes, np.int64), lengths))], ["token", "doc_id", "n"])


def _partners(first: np.ndarray, n: np.ndarray, c: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
    """The shapes of whole blocks, sorted by block and size, whose members can be similar to another member."""
    block = np.cumsum(np.r_[True, first[1:] != first[:-1]]).astype(np.int64) << 32
    keys, reach, upto = block | n, 7 * c / 3 + 3, np.r_[0, np.cumsum(m)]

    def among(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return upto[np.searchsorted(keys, block + np.floor(high).astype(np.int64), "right")] - upto[np.searchsorted(keys, block + np.ceil(low).astype(np.int64), "left")]

    top, bottom = np.minimum(n, 0.75 * n + reach), np.maximum(n, (n - reach) / 0.75)
    others = among(0.75 * n, top) - (top >= n) + among(bottom, n / 0.75) - (bottom <= n)
    return pa.RecordBatch.from_arrays([pa.array(x[others > 0]) for x in (first, n, c)], ["first", "n", "c"])


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shapes (size n, c shared shingles, m members) of blocks with another member there of a size that can bring the similarity.

    A document of size n that meets others under c shingles can only be similar to sets of 3/4 n to 3/4 n + 7/3 c, or the other
    way round: what is left of the longer set behind its prefix cannot make up for more. Rows come sorted by block and size;
    a task holds the shapes of one block and a batch, which the lengths of documents bound, however many there are.
    """
    rest = None
    for batch in batches:
        got = [x.to_numpy() for x in batch.columns]
        if rest:
            got = [np.concatenate(x) for x in zip(rest, got, strict=True)]
        if len(got[0]):
            whole = np.searchsorted(got[0], got[0][-1])  # the last block may go on in the next batch
            yield _partners(*(x[:whole] for x in got))
            rest = [x[whole:] for x in got]
    if rest:
        yield _partners(*rest)


def _texts(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _members(batch, wanted.value)


class Trie:
    """Globally ordered sets under shared prefixes. A node holds a run of shingles, the sets that end with it, and the least and most size below it."""

    def __init__(self, sets: list[np.ndarray]):
        """``sets``: numbers of shingles, ascending."""
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        parent, begin, end, source = [0], [0], [0], [order[0]]
        self.node_of = np.zeros(len(sets), np.int64)
        path, before = [0], None
        for i in order:
            s, shared = sets[i], 0
            if before is not None:
                m = min(len(s), len(before))
                differs = np.flatnonzero(s[:m] != before[:m])
                shared = int(differs[0]) if len(differs) else m
            last = None
            while end[path[-1]] > shared:
                last = path.pop()
            if end[path[-1]] < shared:  # a node is cut where this set leaves it
                for column, value in ((parent, path[-1]), (begin, end[path[-1]]), (source, source[last]), (end, shared)):
                    column.append(value)
                path.append(len(parent) - 1)
                parent[last], begin[last] = path[-1], shared
            if len(s) > shared:
                parent.append(path[-1])
                begin.append(shared)
                end.append(len(s))
                source.append(i)
                path.append(len(parent) - 1)
            self.node_of[i] = path[-1]
            before = s
        self.parent, self.begin, self.end = np.array(parent), np.array(begin), np.array(end)
        self.sizes = np.array([len(s) for s in sets])
        runs = [sets[d][a:z] for d, a, z in zip(source, begin, end, strict=True)]
        self.last = np.array([r[-1] if len(r) else -1 for r in runs])
        tokens, nodes = np.concatenate(runs), np.repeat(np.arange(len(runs), dtype=np.int32), self.end - self.begin)
        by_token = np.argsort(tokens, kind="stable")
        self.holders, self.first = nodes[by_token], np.searchsorted(tokens[by_token], np.arange(int(max(s[-1] for s in sets)) + 2))
        level = np.zeros(len(parent), np.int64)
        for node in np.argsort(self.begin, kind="stable")[1:]:
            level[node] = level[self.parent[node]] + 1
        self.levels = [np.flatnonzero(level == i) for i in range(1, int(level.max()) + 1)]
        self.least, self.most = np.full(len(parent), 1 << 40), np.zeros(len(parent), np.int64)
        np.minimum.at(self.least, self.node_of, self.sizes)
        np.maximum.at(self.most, self.node_of, self.sizes)
        for nodes in reversed(self.levels):
            np.minimum.at(self.least, self.parent[nodes], self.least[nodes])
            np.maximum.at(self.most, self.parent[nodes], self.most[nodes])

    def similar_to(self, q: np.ndarray, n: int) -> np.ndarray:
        """The sets whose similarity is 0.75 or more with a set of size n; q: those of its shingles that are stored."""
        count = self.first[q + 1] - self.first[q]
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[q], count)
        overlap = np.bincount(self.holders[entry], minlength=len(self.parent))
        alive = np.zeros(len(self.parent), bool)
        alive[0] = True
        for nodes in self.levels:
            nodes = nodes[alive[self.parent[nodes]]]
            overlap[nodes] += overlap[self.parent[nodes]]
            rest = np.minimum(len(q) - np.searchsorted(q, self.last[nodes], "right"), self.most[nodes] - self.end[nodes])
            alive[nodes] = 7 * (overlap[nodes] + rest) >= 3 * (n + self.least[nodes])
        return np.flatnonzero(alive[self.node_of] & (7 * overlap[self.node_of] >= 3 * (n + self.sizes)))


def _links(docs: list[int], sides: list[bool], sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Similar pairs of a block that connect what is not connected yet. Of a block cut in two, pairs across are looked for."""
    if len(docs) < 2:
        return
    leader = list(range(len(docs)))

    def top(i: int) -> int:
        while leader[i] != i:
            leader[i] = i = leader[leader[i]]
        return i

    _, number = np.unique(~np.concatenate(sets), return_inverse=True)  # common ones first
    local = [np.sort(x) for x in np.split(number.astype(np.uint32), np.cumsum([len(s) for s in sets])[:-1])]
    del number
    cut = True in sides and False in sides
    stored = [i for i in range(len(docs)) if sides[i] or not cut]
    trie = Trie([local[i] for i in stored])
    for i, q in enumerate(local):
        if cut and sides[i]:
            continue
        q = q[q < len(trie.first) - 1]
        if not len(q):
            continue
        for j in trie.similar_to(q, len(local[i])).tolist():
            a, b = top(i), top(stored[j])
            if a != b:
                leader[max(a, b)] = min(a, b)
                if docs[i] != docs[stored[j]]:
                    yield docs[i], docs[stored[j]]


def _checked(batches: Iterator[pa.RecordBatch], size: int, common: Broadcast) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block."""
    hot, rank = common.value
    block, docs, sides, sets = None, [], [], []
    for batch in batches:
        found: list[tuple[int, int]] = []
        row = zip(*(batch.column(c).to_pylist() for c in ("first", "part", "doc_id", "side")), strict=True)
        for w in chunks(batch.column("text"), LOWER):
            for s in _row_sets(w, size):
                first, part, doc, side = next(row)
                if (first, part) != block:
                    found += _links(docs, sides, sets)
                    block, docs, sides, sets = (first, part), [], [], []
                if len(s):
                    docs.append(doc)
                    sides.append(side)
                    sets.append(_ordered(s, hot, rank))
        yield _pairs(found)
    yield _pairs(list(_links(docs, sides, sets)))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _dealt(members: DataFrame) -> DataFrame:
    """``first, part, side, doc_id`` from ``first, doc_id, n``. Blocks of more than ``BLOCK`` members or ``PART`` shingles are dealt into lots, and a part is one lot or, with a side each, two; so every pair is in one part."""
    sizes = members.groupBy("first").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    lots = F.ceil(2 * F.greatest(F.col("members") / BLOCK, F.col("shingles") / PART))
    large = kept(sizes.where(f"members > 1 AND (members > {BLOCK} OR shingles > {PART})").select("first", F.least(lots, "members").cast("int").alias("lots")), "large-blocks")
    rows = members.join(large, "first", "left").withColumn("lots", F.coalesce("lots", F.lit(1)))
    rows = rows.withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.col("lots")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    return rows.select("first", (F.least("lot", "other") * F.col("lots") + F.greatest("lot", "other")).alias("part"), (F.col("lot") > F.col("other")).alias("side"), "doc_id")


def _blocks(rows: DataFrame) -> DataFrame:
    """``first, doc_id, n`` from ``token, doc_id, n`` of prefixes: the members of blocks. What is known of a shingle or a shape is written before the rows are joined with it, so that Spark can split the rows of a common one."""
    rows = kept(rows, "prefixes")
    ends = kept(rows.groupBy("token").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("token", "first"), "first-documents")
    sized = rows.join(ends, "token").groupBy("first", "doc_id", "n").agg(F.count("*").alias("c"))
    sized = kept(sized.withColumn("c", F.sum("c").over(Window.partitionBy("doc_id", "n"))), "sized")
    dropped(rows)
    dropped(ends)
    shapes = sized.groupBy("first", "n", "c").agg(F.count("*").alias("m")).repartition("first").sortWithinPartitions("first", "n")
    shapes = kept(shapes.mapInArrow(Trimmed(_with_partners), "first long, n long, c long"), "shapes")
    members = kept(sized.join(shapes, ["first", "n", "c"]).groupBy("first", "doc_id").agg(F.sum("n").alias("n")), "members")
    dropped(sized)
    dropped(shapes)
    return members


def jaccard_join(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row for each row of ``docs`` (``doc_id``, ``text``).

    A document's set: its distinct ``size``-word shingles, words being lower-cased (A-Z) runs without ASCII white space;
    with fewer words the whole sequence is one shingle; without words or text the set is empty and linked with nothing.
    Documents link when 100 * intersection >= 75 * union; ``component_id`` is the smallest id reachable by links. Rows with
    equal ids count as one document; a row with a null id is linked with nothing and has a null component. An empty table
    gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark, BATCH)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = kept(own.mapInArrow(Trimmed(partial(_classes, size=size)), "doc_id long, n long, h1 long, h2 long"), "sets")
    named = sets.where("doc_id IS NOT NULL AND n > 0")
    firsts = named.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("first"))
    classes = kept(named.join(firsts, ["h1", "h2", "n"]).select("doc_id", "n", "first"), "classes")
    firsts = classes.select("first").distinct()
    wanted = spark.sparkContext.broadcast(bloom.build(firsts, bloom.blocks_for(firsts.count())))

    own = own.where("doc_id IS NOT NULL")
    counts = own.mapInArrow(Trimmed(partial(_prefix_counts, size=size, wanted=wanted)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    common = spark.sparkContext.broadcast(_common(counts))
    counts = own.mapInArrow(Trimmed(partial(_prefix_counts, size=size, wanted=wanted, common=common)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    again = kept(counts.where("n > 1").select("token"), "repeated-shingles")
    again = spark.sparkContext.broadcast(bloom.build(again, bloom.blocks_for(again.count(), most=bloom.MOST_BLOCKS * 4)))
    rows = own.mapInArrow(Trimmed(partial(_prefixes, size=size, wanted=wanted, common=common, again=again)), "token long, doc_id long, n long")
    members = _blocks(rows)
    again.destroy()
    wanted.destroy()
    ids = members.select("doc_id").distinct()
    needed = spark.sparkContext.broadcast(bloom.build(ids, bloom.blocks_for(ids.count())))
    texts = _dealt(members).join(own.mapInArrow(Trimmed(partial(_texts, wanted=needed)), own.schema), "doc_id").repartition("first", "part").sortWithinPartitions("first", "part")
    links = kept(texts.mapInArrow(Trimmed(partial(_checked, size=size, common=common)), "a long, b long"), "links")
    needed.destroy()
    common.destroy()
    repeated = classes.groupBy("doc_id").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low < high").select("doc_id")
    links = links.union(classes.join(repeated, "doc_id").select("doc_id", "first"))
    found = components(links)

    of_class = classes.select("doc_id", "first").groupBy("doc_id").agg(F.min("first").alias("first"))
    of_doc = of_class.join(found, of_class["first"] == found["node"], "left").select("doc_id", F.coalesce("component", "first").alias("component"))
    return sets.join(of_doc, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text`` and more) without near copies: of each group that links join, the row with the smallest id stays, and of several texts with that id the one whose MD5 sum is smallest.

    Texts count by themselves, also where they share an id: a text goes only if another one of its group stays. Of rows with
    the same id and text one stays. Rows with a null id are linked with nothing and all stay; texts without words too.
    """
    md5 = F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))
    own = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__md5": md5})
    texts = own.where("__id IS NOT NULL").groupBy("__id").agg(F.min("__md5").alias("low"), F.max("__md5").alias("high"), F.count("*").alias("n"))
    shared = kept(texts.where("n > 1"), "shared-ids")
    # Texts that share an id get numbers beyond all ids; most documents have an id of their own and keep it.
    several = own.join(shared.where("low < high").select("__id"), "__id").select("__id", "__md5").distinct()
    beyond = max(0, docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0)
    numbers = kept(several.withColumn("__number", F.monotonically_increasing_id() + (beyond + 1)), "numbers-of-texts")
    same = (F.col("__id") == F.col("__of")) & (F.col("__md5") == F.col("__text"))
    named = own.join(numbers.select(F.col("__id").alias("__of"), F.col("__md5").alias("__text"), "__number"), same, "left").withColumn("__node", F.coalesce("__number", "__id")).drop("__of", "__text", "__number")

    joined = jaccard_join(named.select(F.col("__node").alias("doc_id"), "text"), size).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__node"), "component_id").distinct()
    joined = kept(joined, "groups-of-texts")
    # A component is named by its smallest node, which is its smallest id, unless it has texts with a number beyond the ids.
    first = joined.join(numbers.withColumnRenamed("__number", "__node"), "__node", "left").select("__node", "component_id", F.coalesce("__id", "__node").alias("__id"), F.coalesce("__md5", F.lit("")).alias("__md5"))
    odd = kept(joined.join(numbers.select(F.col("__number").alias("__node")), "__node").select("component_id").distinct(), "odd-groups")
    stays = first.join(odd, "component_id").groupBy("component_id").agg(F.min(F.struct("__id", "__md5", "__node")).alias("s")).select("component_id", F.col("s.__node").alias("stays"))
    gone = joined.join(kept(stays, "kept-texts"), "component_id", "left").where(F.col("__node") != F.coalesce("stays", "component_id")).select("__node")
    # Written in order, where ids take little room: Spark knows their size before it plans the join, and shuffles texts only if they are many.
    gone = kept(gone.sort("__node"), "removed-texts")
    left = named.join(gone, "__node", "left_anti")
    # Only rows of ids that stand in several rows are compared with each other.
    once = left.join(shared.select("__id"), "__id", "left_semi").dropDuplicates(["__id", "__md5"])
    return left.join(shared.select("__id"), "__id", "left_anti").unionByName(once).select(*docs.columns)


def _common(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles in ``HOT`` prefixes or more (the ``MOST_HOT`` commonest, should there be more: the order only saves work), sorted, and their ranks from the rarest."""
    got = counts.where(f"n >= {HOT}").orderBy(F.desc("n"), "token").limit(MOST_HOT).toArrow()
    tokens, n = got["token"].to_numpy().view(U), got["n"].to_numpy()
    by_count = np.lexsort((tokens, n))
    rank = np.empty(len(tokens), U)
    rank[by_count] = np.arange(len(tokens), dtype=U)
    order = np.argsort(tokens)
    return tokens[order], rank[order]
