"""Near-duplicate documents by a chosen-path set similarity join.

A document's set is its distinct two-word shingles; documents link if 100 * |A & B| >= 80 * |A | B|.
Documents with equal sets are one node from the start.  A node has ``TOKENS`` minwise tokens that
sort and sift pairs, and ``TREE_TOKENS`` others for each tree.  In each of several trees a document
starts at the root and descends along the tree's tokens: at a tree node, positions are chosen by a
hash of the path (one, now and then two, on average 1 / similarity), and the document goes on to the
child for its token at each.  Similar documents share tokens and so meet.  No two trees share a
token, so they are independent; their number follows from the wanted recall at the threshold, the
binomial agreement of a tree's tokens and the depth.

Tree nodes of one document are dropped, and of tree nodes with the same members one is kept.  Small
ones (``LEAF`` documents) are compared exhaustively: token agreement sorts the pairs, pairs that
aren't connected yet are confirmed on the full sets, and each class found is told as a star (its
smallest set with each other one), never as all pairs.  Larger ones first link their documents to a
few leaders.  Where half of a tree node's documents are of one class by then, the others are
compared with that class, once for all trees and block by block, and with each other in a tree node
of their own; where not, the documents branch on, ``STEP`` levels at a time, and as fewer pairs survive a longer
path, they are put into further trees, down to the same depth.  What is still large after
``MAX_STEPS`` such steps is compared exhaustively, block by block.  Components of all links give each
document its class.

A pair is missed with a chance of ``1 - RECALL`` at most: half of it goes to the first depth, half of
the rest to each further step, and what is left to the sifting by token agreement.

The depth of the first comparison grows with the logarithm of the number of sets.  Ids of sets
needed for the comparisons are broadcast only up to ``MAX_BROADCAST`` of them; beyond, the
documents are joined by a shuffle.

Null and empty texts, and texts of white space, have no set and link with nothing.  A text of one
word has that word as its set.  Without a doc_id a document can link others, but names no class; a
class without any id has a null id, and its documents are all kept.  Repeated rows are in one
class.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.components import components
from kestrel.llm.textnum import U64, WordHasher, map_batches, mix, separators, slices
from kestrel.plans.materialize import RunTables, write_and_reload

SIMILAR = (80, 100)  # intersection * 100 >= union * 80
TOKENS = 48
TREE_TOKENS = 24  # of each tree, its own
RECALL = 0.9999
BACKGROUND = 0.03  # similarity of unrelated documents, for the depth
LEAF = 2048
LEAF_SHINGLES = 2_000_000
TINY = 16  # so many documents are a leaf whatever their sizes
STEP = 2
MAX_STEPS = 6
LEADERS = 3
BLOCK = 512
MAX_BROADCAST = 1_000_000
SPACE = separators(b" \t\n\x0b\x0c\r")

Keep = Callable[[DataFrame, str], DataFrame]

_PAIR = U64(0xD6E8FEB86659FD93)
_PATH = U64(0xA0761D6478BD642F)
_PLACE = U64(0xE7037ED1A0B428DB)


def shingles(texts: pa.Array, hasher: WordHasher) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's two-word shingles (of its words, if it has but one)."""
    words, offsets = hasher.words(texts)
    pairs = mix(words[:-1] * _PAIR + words[1:]) if len(words) else words
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        out.append(np.unique(pairs[a:b - 1]) if b - a > 1 else mix(words[a:b] + _PAIR))
    return out


def _smallest(set_: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """For each multiplier the smallest product."""
    best, size = np.full(len(multipliers), 2**64 - 1, np.uint64), max(1, (1 << 17) // len(multipliers))
    for i in range(0, len(set_), size):
        best = np.minimum(best, (set_[None, i:i + size] * multipliers[:, None]).min(axis=1))
    return best


def tokens(set_: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Minwise tokens: for each multiplier the upper half of the smallest product."""
    return (_smallest(set_, multipliers) >> U64(32)).astype(np.uint32)


def tree_tokens(set_: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Minwise tokens of the trees: for each multiplier 16 bits of a hash of the smallest product."""
    return (mix(_smallest(set_, multipliers)) >> U64(48)).astype(np.uint16)


def multipliers() -> np.ndarray:
    """Odd factors, one for each token."""
    return np.random.default_rng(41).integers(0, 2**63, TOKENS, dtype=np.uint64) * U64(2) + U64(1)


def tree_multipliers(trees: int) -> np.ndarray:
    """Odd factors, ``TREE_TOKENS`` for each tree; those of a tree don't depend on how many there are."""
    return np.random.default_rng(43).integers(0, 2**63, trees * TREE_TOKENS, dtype=np.uint64) * U64(2) + U64(1)


def agreement(similarity: float, n: int) -> list[float]:
    """Chances that 0, 1, ... n of n tokens agree."""
    return [math.comb(n, k) * similarity**k * (1 - similarity)**(n - k) for k in range(n + 1)]


def survival(similarity: float, levels: int) -> float:
    """Chance that two documents of this similarity share a path of so many levels in one tree: the
    mean over how many of the tree's tokens agree."""
    one, two, mean = 2 - 1 / similarity, 1 / similarity - 1, 0.0
    for k, chance in enumerate(agreement(similarity, TREE_TOKENS)):
        s = 1.0
        for _ in range(levels):
            miss = 1 - k / TREE_TOKENS * s
            s = 1 - one * miss - two * miss * miss
        mean += chance * s
    return mean


def trees_needed(similarity: float, levels: int, recall: float) -> int:
    """Independent trees for the wanted recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, levels)))


def depth(n: int) -> int:
    """Levels before the first comparison of n sets."""
    return max(2, math.ceil(math.log(max(n, 2)) / -math.log(BACKGROUND)))


def trees_at(levels: int, step: int) -> int:
    """Trees after so many steps; ``levels``: those before the first."""
    return trees_needed(SIMILAR[0] / SIMILAR[1], levels + STEP * step, 1 - (1 - RECALL) / 2**(step + 1))


def least_agreement() -> int:
    """Tokens of ``TOKENS`` that agree in all but a negligible share of similar pairs."""
    below, chances = 0.0, agreement(SIMILAR[0] / SIMILAR[1], TOKENS)
    for k, chance in enumerate(chances):
        below += chance
        if below > (1 - RECALL) / 2**(MAX_STEPS + 1):
            return k
    return TOKENS


def descend(path: np.ndarray, row: np.ndarray, tokens_: np.ndarray, levels: int, similarity: float):
    """Paths and rows after so many more levels; ``tokens_``: (rows, tokens)."""
    n = tokens_.shape[1]
    twice = U64(int((1 / similarity - 1) * 2**32))
    for _ in range(levels):
        h = mix(path * _PATH + _PLACE)
        first = (h % U64(n)).astype(np.int64)
        second = (first + 1 + ((h >> U64(8)) % U64(n - 1)).astype(np.int64)) % n
        more = (h >> U64(32)) < twice
        place = np.concatenate([first, second[more]])
        row = np.concatenate([row, row[more]])
        path = np.concatenate([path, path[more]])
        path = mix((path + place.astype(np.uint64) * _PLACE) * _PATH + tokens_[row, place].astype(np.uint64))
    return path, row


def _tokens_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, TOKENS)


def features(documents: DataFrame, trees: int) -> DataFrame:
    """``doc_id, key, n_shingles, set_id, tokens, tree_tokens``: ``key`` names the row (id and text),
    ``set_id`` the set (null without one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, factors, tree_factors = WordHasher(SPACE), multipliers(), tree_multipliers(trees)
        for batch in batches:
            for rows in slices(batch, "text"):
                sets = shingles(rows.column("text"), hasher)
                ids = [int(mix(np.array([s.sum(dtype=np.uint64) ^ U64(len(s))]))[0]) - 2**63 if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id"), rows.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array([tokens(s, factors).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array([tree_tokens(s, tree_factors).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "key", "n_shingles", "set_id", "tokens", "tree_tokens"])

    named = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                             F.xxhash64("doc_id", "text").alias("key"))
    return map_batches(
        named, run, "doc_id long, key long, n_shingles long, set_id long, tokens binary, tree_tokens binary")


def _branch(rows: DataFrame, levels: int, similarity: float, trees: range | None = None) -> DataFrame:
    """``set_id, n_shingles, tree, path`` after ``levels`` more levels; ``rows``: set_id, n_shingles,
    tree_tokens (of all trees) and, unless at the roots of ``trees``, tree and path."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                t = np.frombuffer(b"".join(part.column("tree_tokens").to_pylist()), "<u2")
                t, at = t.reshape(part.num_rows, -1, TREE_TOKENS), np.arange(part.num_rows)
                if trees:
                    at, tree = np.repeat(at, len(trees)), np.tile(np.array(trees), len(at))
                    path = mix((tree + 1).astype(np.uint64) * _PATH)
                    t = t[:, trees.start:trees.stop].reshape(-1, TREE_TOKENS)
                else:
                    tree, path = part.column("tree").to_numpy(), part.column("path").to_numpy().view(np.uint64)
                    t = t.reshape(-1, TREE_TOKENS)
                path, row = descend(path, np.arange(len(at)), t, levels, similarity)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(part.column(c).to_numpy()[at[row]]) for c in ("set_id", "n_shingles")),
                     pa.array(tree[row].astype(np.int32)), pa.array(path.view(np.int64))], ["set_id", "n_shingles", "tree", "path"])

    if trees:
        rows = rows.select("set_id", "n_shingles", "tree_tokens")
    else:
        own = F.substring("tree_tokens", F.col("tree") * (2 * TREE_TOKENS) + 1, F.lit(2 * TREE_TOKENS))
        rows = rows.select("set_id", "n_shingles", "tree", "path", own.alias("tree_tokens"))
    return map_batches(rows, run, "set_id long, n_shingles long, tree int, path long")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """True if the sets (sorted, distinct) are similar enough."""
    low, full = SIMILAR
    if min(len(a), len(b)) * full < low * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return both * full >= low * (len(a) + len(b) - both)


def spanning_links(ids: list[int], marks: np.ndarray, sets: list[np.ndarray], split: int = 0) -> list[tuple[int, int]]:
    """The classes that links make among a tree node's documents, as pairs (smallest id, other id):
    pairs of documents in order of token agreement, each confirmed on the full sets unless its ends
    are connected already.  ``split``: compare only the first so many with the others (0: all with
    all)."""
    n, label = len(ids), np.arange(len(ids))
    least = least_agreement()
    left, right, agree = [], [], []
    for i in range(split or n - 1):
        begin = split or i + 1
        same = (marks[begin:] == marks[i]).sum(axis=1)
        near = np.flatnonzero(same >= least)
        left.append(np.full(len(near), i, np.int32))
        right.append((near + begin).astype(np.int32))
        agree.append(same[near].astype(np.uint8))
    a, b = np.concatenate(left), np.concatenate(right)
    order = np.argsort(TOKENS - np.concatenate(agree), kind="stable")
    a, b = a[order], b[order]
    while len(a):
        joined = False
        for i, j in zip(a[:1024].tolist(), b[:1024].tolist()):
            if label[i] != label[j] and _linked(sets[i], sets[j]):
                label[label == label[j]] = label[i]
                joined = True
        a, b = a[1024:], b[1024:]
        if joined:
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
    named = np.array(ids, np.int64)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, named)
    return [(x, y) for x, y in zip(least[label].tolist(), named.tolist()) if x != y]


def _compare(nodes: DataFrame) -> DataFrame:
    """Links ``a, b``; ``nodes``: path, side (0, or 1 for the second block of a pair), set_id,
    tokens, shingles."""
    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("path", "side", "set_id", "tokens", "shingles")))

        found = []
        for _, group in groupby(rows(), key=lambda r: r[0]):
            group = list(group)
            split = sum(r[1] == 0 for r in group) if group[-1][1] else 0
            if len(group) > 1 and (split or not group[-1][1]):
                marks = np.stack([np.frombuffer(r[3], "<u4") for r in group])
                found += spanning_links([r[2] for r in group], marks, [np.frombuffer(r[4], "<u8") for r in group], split)
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    dealt = nodes.select("path", "side", "set_id", "tokens", "shingles").repartition("path")
    return map_batches(dealt.sortWithinPartitions("path", "side", "set_id"), run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                       pa.array([b for _, b in found], pa.int64())], ["a", "b"])


def _texts(documents: DataFrame, needed: DataFrame, keep: Keep) -> DataFrame:
    """``set_id, text`` of the sets in ``needed`` (set_id, key), from the documents that they name."""
    rows = documents.select("text", F.xxhash64("doc_id", "text").alias("key"))
    needed = keep(needed.select("key", "set_id"), "needed")
    if needed.count() <= MAX_BROADCAST:
        needed = F.broadcast(needed)
    return rows.join(needed, "key").select("set_id", "text")


def _sets(documents: DataFrame, needed: DataFrame, keep: Keep) -> DataFrame:
    """``set_id, tokens, shingles`` (little-endian) of the sets in ``needed`` (set_id, key), made
    anew from the documents that they name."""
    def run(batches):
        hasher, factors = WordHasher(SPACE), multipliers()
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingles(part.column("text"), hasher)
                yield pa.RecordBatch.from_arrays(
                    [part.column("set_id"), pa.array([tokens(s, factors).tobytes() for s in found], pa.binary()),
                     pa.array([s.tobytes() for s in found], pa.binary())], ["set_id", "tokens", "shingles"])

    made = map_batches(_texts(documents, needed, keep), run, "set_id long, tokens binary, shingles binary")
    return made.dropDuplicates(["set_id"])


def _more_tokens(documents: DataFrame, needed: DataFrame, trees: int, keep: Keep) -> DataFrame:
    """``set_id, n_shingles, tree_tokens`` for so many trees, made anew as in ``_sets``."""
    def run(batches):
        hasher, factors = WordHasher(SPACE), tree_multipliers(trees)
        for batch in batches:
            for part in slices(batch, "text"):
                found = shingles(part.column("text"), hasher)
                yield pa.RecordBatch.from_arrays(
                    [part.column("set_id"), pa.array([len(s) for s in found], pa.int64()),
                     pa.array([tree_tokens(s, factors).tobytes() for s in found], pa.binary())],
                    ["set_id", "n_shingles", "tree_tokens"])

    made = map_batches(_texts(documents, needed, keep), run, "set_id long, n_shingles long, tree_tokens binary")
    return keep(made.dropDuplicates(["set_id"]), "more_tokens")


def _kept_nodes(rows: DataFrame, leaf: int) -> DataFrame:
    """``path, n, is_leaf`` of tree nodes with two members or more, one of the leaves with equal
    members.  Large ones all stay: their documents may branch on, in each tree for itself."""
    is_leaf = (F.col("n") <= leaf) & ((F.col("weight") <= LEAF_SHINGLES) | (F.col("n") <= TINY))
    stats = rows.groupBy("path").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("weight"),
        F.sum(F.xxhash64("set_id").cast("decimal(20,0)")).alias("s")).filter("n > 1").withColumn("is_leaf", is_leaf)
    return stats.groupBy("n", "weight", "s", "is_leaf", F.when(~F.col("is_leaf"), F.col("path")).alias("own")).agg(
        F.min("path").alias("path")).select("path", "n", "is_leaf")


def links(documents: DataFrame, nodes: DataFrame, keep: Keep, leaf: int = LEAF, max_steps: int = MAX_STEPS) -> list[DataFrame]:
    """Tables of pairs ``a, b`` that connect all similar sets; ``nodes``: set_id, key, n_shingles,
    tokens, tree_tokens, one row for each distinct set; ``keep`` writes a table and reads it back."""
    similarity = SIMILAR[0] / SIMILAR[1]
    n = nodes.count()
    if n < 2:
        return []
    levels = depth(n)
    trees = trees_at(levels, 0)
    rows = keep(_branch(nodes, levels, similarity, range(trees)), "paths")
    nodes = nodes.drop("tree_tokens")
    found: list[DataFrame] = []
    for step in range(max_steps + 1):
        members = keep(rows.join(_kept_nodes(rows, leaf), "path"), "members")
        small = members.filter("is_leaf")
        sets = _sets(documents, nodes.join(small, "set_id", "left_semi"), keep)
        leaves = small.select("path", "set_id").join(sets, "set_id").withColumn("side", F.lit(0))
        found.append(keep(_compare(leaves), "links"))
        large = members.filter("not is_leaf")
        if large.isEmpty():
            break
        large = keep(large.select("path", "tree", "set_id", "n").join(nodes, "set_id"), "large")
        found.append(_leader_links(documents, large, keep))
        rows, across = _after_leaders(large, components(_union(found), keep), keep)
        found.append(keep(_across(documents, nodes, across, keep), "links"))
        if rows.isEmpty():
            break
        if step == max_steps:
            found.append(_block_links(documents, nodes, rows, keep))
            break
        on = keep(rows.filter("branches").drop("branches"), "on")
        rows = rows.filter("not branches").drop("branches")
        if not on.isEmpty():
            more = trees_at(levels, step + 1)
            made = _more_tokens(documents, nodes.join(on, "set_id", "left_semi"), more, keep)
            first = on.filter(F.col("tree") < trees).join(made.drop("n_shingles"), "set_id")
            rows = rows.unionByName(_branch(first, STEP, similarity))
            if more > trees:  # anew from the root: a document may branch on for the first time
                rows = rows.unionByName(_branch(made, levels + STEP * (step + 1), similarity, range(trees, more)))
            rows = keep(rows, "paths")
    return found


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _after_leaders(large: DataFrame, classes: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """What is left to compare.  First the rows ``path, tree, set_id, n_shingles, branches``: of a tree node
    half of which is one class, the other documents; of one without such a class, all.  Then
    ``set_id, root, to``: documents, their classes, and the classes of their tree nodes to compare
    them with (null: none)."""
    named = large.join(classes.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id"))
    shares = named.groupBy("path", "root").agg(F.count("*").alias("share"))
    top = shares.groupBy("path").agg(F.max_by("root", F.struct("share", "root")).alias("top"),
                                     F.max("share").alias("share"))
    named = named.join(top, "path").withColumn("branches", F.col("share") * 2 < F.col("n"))
    named = keep(named.select(
        "path", "tree", "set_id", "n_shingles", "root", "branches",
        F.when(~F.col("branches") & (F.col("root") != F.col("top")), F.col("top")).alias("to"),
        (F.col("root") == F.col("top")).alias("in_top")), "named")
    rest = named.filter("branches or not in_top").select("path", "tree", "set_id", "n_shingles", "branches")
    return rest, named.select("set_id", "root", "to")


def _across(documents: DataFrame, nodes: DataFrame, across: DataFrame, keep: Keep) -> DataFrame:
    """Pairs that connect documents with the classes ``to`` of their tree nodes: each document is
    compared with each member of the class, in blocks of both."""
    ours = across.filter("to is not null").select("set_id", "to").distinct()
    theirs = (across.select("set_id", F.col("root").alias("to")).distinct()
              .join(ours.select("to").distinct(), "to", "left_semi"))
    sizes = (ours.groupBy("to").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n0"))
             .join(theirs.groupBy("to").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n1")), "to"))

    def dealt(members: DataFrame, side: int, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("set_id"), F.col(own)).cast("int")
        rows = members.join(sizes, "to").withColumn("mine", mine).withColumn(
            "others", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        blocks = ("mine", "others") if side == 0 else ("others", "mine")
        return rows.select(F.xxhash64("to", *blocks).alias("path"), F.lit(side).alias("side"), "set_id")

    pairs = keep(dealt(ours, 0, "n0", "n1").unionByName(dealt(theirs, 1, "n1", "n0")), "across")
    return _compare(pairs.join(_sets(documents, nodes.join(pairs, "set_id", "left_semi"), keep), "set_id"))


def _leader_links(documents: DataFrame, large: DataFrame, keep: Keep) -> DataFrame:
    """Links of large tree nodes' documents to the best of their nodes' leaders, ``LEADERS`` each
    chosen by hash.  Just a head start: nothing is left out for lack of such a link."""
    hashes = [F.xxhash64(F.lit(k), F.col("set_id")) for k in range(LEADERS)]
    chosen = large.groupBy("path").agg(*(
        F.min_by(F.struct("set_id", "tokens"), h).alias(f"l{k}") for k, h in enumerate(hashes)))
    pairs = large.join(chosen, "path").select(
        "set_id", "tokens", F.explode(F.array(*(f"l{k}" for k in range(LEADERS)))).alias("leader")).filter(
        F.col("set_id") != F.col("leader.set_id")).select(
        "set_id", "tokens", F.col("leader.set_id").alias("to"), F.col("leader.tokens").alias("to_tokens"))

    def run(batches):
        threshold = SIMILAR[0] / SIMILAR[1]
        for batch in batches:
            if batch.num_rows:
                agree = (_tokens_of(batch.column("tokens")) == _tokens_of(batch.column("to_tokens"))).sum(axis=1)
                pick = pa.array(np.flatnonzero(agree >= threshold * TOKENS))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("set_id").take(pick), batch.column("to").take(pick),
                     pa.array(agree[agree >= threshold * TOKENS].astype(np.int32))], ["set_id", "to", "agree"])

    near = map_batches(pairs, run, "set_id long, to long, agree int")
    best = keep(near.groupBy("set_id").agg(F.max_by("to", F.struct("agree", "to")).alias("to")), "leaders")
    ids = best.select("set_id").unionByName(best.select(F.col("to").alias("set_id")))
    sets = keep(_sets(documents, large.select("set_id", "key").dropDuplicates(["set_id"]).join(
        ids, "set_id", "left_semi"), keep), "sets")
    both = best.join(sets.select("set_id", "shingles"), "set_id").join(
        sets.select(F.col("set_id").alias("to"), F.col("shingles").alias("to_shingles")), "to")

    def confirm(batches):
        for batch in batches:
            ok = [_linked(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")) for a, b in zip(
                batch.column("shingles").to_pylist(), batch.column("to_shingles").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("set_id").filter(pa.array(ok, pa.bool_())),
                                              batch.column("to").filter(pa.array(ok, pa.bool_()))], ["a", "b"])

    both = both.select("set_id", "to", "shingles", "to_shingles")
    return keep(map_batches(both, confirm, "a long, b long"), "links")


def _block_links(documents: DataFrame, nodes: DataFrame, rows: DataFrame, keep: Keep) -> DataFrame:
    """Pairs that connect tree nodes which stayed large: exhaustive over pairs of blocks."""
    size = rows.groupBy("path").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.select("path", "set_id").join(size, "path").withColumn(
        "own", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    pairs = keep(dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("path"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "set_id"), "blocks")
    sets = _sets(documents, nodes.join(pairs, "set_id", "left_semi"), keep)
    return keep(_compare(pairs.join(sets, "set_id")), "links")


def _rooted(documents: DataFrame, tables: RunTables, leaf: int, max_steps: int) -> DataFrame:
    """``doc_id, key, n_shingles, set_id, root`` of each row: ``key`` names id and text, ``root`` the
    class (null without a set)."""
    rows = tables.add(features(documents, trees_at(depth(documents.count()), 0)), "features")
    nodes = tables.add(rows.filter("n_shingles > 0").groupBy("set_id").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
        F.first("tree_tokens").alias("tree_tokens")), "nodes")
    found = links(documents, nodes, tables.add, leaf, max_steps)
    narrow = rows.select("doc_id", "key", "n_shingles", "set_id")
    if found:
        classes = components(_union(found), tables.add)
        narrow = narrow.join(classes.withColumnRenamed("node", "set_id"), "set_id", "left")
        narrow = narrow.withColumn("root", F.coalesce("root", "set_id"))
    else:
        narrow = narrow.withColumn("root", F.col("set_id"))
    return tables.add(narrow, "rooted")


def near_duplicates(documents: DataFrame, leaf: int = LEAF, max_steps: int = MAX_STEPS) -> DataFrame:
    """Per document: size of its set, the smallest doc_id of its class, and whether it is that one.
    Tables on the way are dropped; what is returned is read from a written one."""
    with RunTables(documents.sparkSession, "near-duplicates") as tables:
        narrow = _rooted(documents, tables, leaf, max_steps)
        first = narrow.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
        out = narrow.join(first, "root", "left").withColumn(
            "component_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")))
        return write_and_reload(out.select(
            "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), "classes")


def surplus(documents: DataFrame) -> DataFrame:
    """``key, kept`` of the rows that aren't needed to have one of each class: ``key`` is xxhash64 of
    doc_id and text.  Those not kept go; those kept occur more than once, and one of them stays.  Of a
    class the row with the smallest doc_id is kept (null ids last; ties by key)."""
    with RunTables(documents.sparkSession, "near-duplicates") as tables:
        rows = _rooted(documents, tables, LEAF, MAX_STEPS).groupBy("key").agg(
            F.first("doc_id").alias("doc_id"), F.first("root").alias("root"), F.count("*").alias("n"))
        rows = tables.add(rows, "distinct")
        first = rows.filter("root is not null").groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))["key"].alias("first"))
        rows = rows.join(first, "root", "left").withColumn("kept", F.coalesce(F.col("key") == F.col("first"), F.lit(True)))
        return write_and_reload(rows.filter("not kept or n > 1").select("key", "kept"), "surplus")


NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, d.doc_id = min(other) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, n
"""
