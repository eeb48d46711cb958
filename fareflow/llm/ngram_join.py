"""N-gram Jaccard self-join with prefix trees, and its connected classes.

Sets are the distinct word n-grams of a text as 64-bit hashes; the order of
the hashes is the global order.  Two sets link when
intersection / union >= threshold.

Dealing out.  Of two linked sets at most ``k`` elements are in one only, k
from the sizes.  The hash range is cut into k + 1 + r stretches, so linked sets
agree on at least r + 1 whole stretches; a stretch's content is a signature.
Stretches with fewer elements than ``need`` (two, or one where stretches are
short) are weak: a set with at most r of them needs no weak signature, other
sets give theirs too.  Sizes fall into classes
that fix the cut; a set near the top of its class signs for the next one as
well.  No linked pair is lost.  Moreover a set with w <= r weak stretches
shares at least r + 1 - w signatures with each set that it links to, so sets
with fewer shared signatures (those with a common passage, say) drop out.  The
sets left that share a signature form a bucket, its smallest id the pivot.

Joining.  A bucket's sets are put into a trie over the global order, in strides
of elements; the trie is traversed for all query sets at once, level by level.
Sets with a common beginning share nodes and so their partial overlap; a
subtree is left when the overlap so far and what can remain on either side
cannot reach the threshold, or, at a leaf, when both ends are already known to
be linked through others.

Classes.  Sets with equal content are one node.  Sets meet their pivots first,
and only buckets that hold several classes after that are joined as a whole, in
pairs of blocks of bounded size (``pivots``): a family of n near copies ships n
texts and gives n edges.  Classes are the connected components.

Links.  Counting each document's links or listing them needs every pair, so no
pair is skipped there for being connected already.  Two sets may meet in several
stars; the pair counts in the one with the smallest root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import (
    flag_maybe, fresh, groups_to_members, maybe_in, passing, release, small_batches, staged, text_chunks,
)
from fareflow.llm.pivots import linked_classes, shared_shingles
from fareflow.llm.tokens import Tokens, mix

NGRAM = 3
#: Threshold as a fraction of integers: 100 * intersection >= 90 * union.
PERCENT = 90
BLOCK = 512
#: Sets of a block hold so many n-grams at most (a larger set is a block of its own).
BLOCK_SHINGLES = 1 << 19
#: N-grams of the sets whose texts travel at once: half of those of all rows, or so many if that is more.
TRAVEL_SHINGLES = 1 << 24
#: A set's n-grams in the lowest of so many parts of the hash range tell whether a pair may link.
FEW_PARTS = 6
#: Elements that a search compares at once, four times those that the look at part of the sets does.
AT_ONCE = 1 << 20
STRIDE = 16
#: Up to so many sets a trie is at most LEVELS high.
FEW, LEVELS = 64, 6
SALTS = 64
_CLASS_RATIO = 1.5


def ngram_sets(texts: pa.Array, ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct n-grams, sorted; a text with fewer words
    has its whole word sequence as one, a text without words none."""
    t = Tokens(texts)
    h, doc = t.hash, t.doc
    size = len(h) - ngram + 1
    owners, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if size > 0:
        g = np.full(size, np.uint64(ngram))
        for k in range(ngram):
            g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[k:k + size])
        same = doc[:size] == doc[ngram - 1:]
        grams.append(g[same])
        owners.append(doc[:size][same])
    first = np.cumsum(t.words) - t.words
    for i in np.flatnonzero((t.words > 0) & (t.words < ngram)):
        g = np.uint64(t.words[i])
        with np.errstate(over="ignore"):
            for x in h[first[i]:first[i] + t.words[i]]:
                g = mix(np.array([g * np.uint64(0x9E3779B97F4A7C15) + x]))[0]
        grams.append(np.array([g], dtype=np.uint64))
        owners.append(np.array([i]))
    own, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.lexsort((gram, own))
    own, gram = own[order], gram[order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (gram[1:] != gram[:-1])
    return own[new], gram[new]


def cell_sets(texts: pa.Array, ngram: int) -> list[np.ndarray]:
    """Sets of a cell's texts, sorted, as codes in one order.  Words are
    hashed a chunk at a time: what that holds is many times the text."""
    sets = []
    for chunk in text_chunks(texts):
        own, gram = ngram_sets(chunk, ngram)
        sets += np.split(gram, np.searchsorted(own, np.arange(1, len(chunk))))
    sizes = [len(s) for s in sets]
    codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)[1].astype(np.int64)
    return np.split(codes, np.cumsum(sizes)[:-1]) if sets else []


def _differences(top: int, percent: int) -> int:
    """Most elements that lie in one only of two linked sets of up to ``top``
    elements: union - intersection <= (100 - p) / (100 + p) * (sum of sizes)."""
    return (100 - percent) * 2 * top // (100 + percent)


def size_classes(largest: int, percent: int) -> list[tuple[int, int]]:
    """(lowest, highest) size of each class; smaller sets link with equal sets only."""
    low = 1
    while _differences(low, percent) == 0 and 100 * low < percent * (low + 1):
        low += 1
    out = []
    while not out or out[-1][1] < largest:
        top = max(low, int(low * _CLASS_RATIO))
        out.append((low, top))
        low = top + 1
    return out


def signatures(own: np.ndarray, gram: np.ndarray, rows: int, percent: int) -> list[list[tuple[int, np.ndarray]]]:
    """Per text and size class that it signs for: how many signatures it must
    share with a set that it links to, and its signatures (see module text)."""
    sizes = np.bincount(own, minlength=rows)
    classes = size_classes(int(sizes.max(initial=1)) * 2, percent)
    lows = np.array([c[0] for c in classes])
    own_class = np.searchsorted(lows, sizes, side="right") - 1
    nxt = np.minimum(own_class + 1, len(classes) - 1)
    up = (100 * sizes >= percent * lows[nxt]) & (nxt > own_class) & (sizes > 0)
    found: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(rows)]
    for klass, member in ((own_class, (own_class >= 0) & (sizes > 0)), (nxt, up)):
        for c in np.unique(klass[member]):
            docs = member & (klass == c)
            _class_signatures(own, gram, docs, int(c), *classes[c], percent, found)
    return found


def _cut(low: int, top: int, percent: int) -> tuple[int, int, int]:
    """(cuts, spare, need) of a size class: how many weak stretches a set of
    the lowest size has is about Poisson, and few sets exceed ``spare``."""
    least = _differences(top, percent) + 1
    need = 2 if low / least >= 5 else 1
    spare = 1
    for _ in range(8):
        mean = low / (least + spare)
        weak = (least + spare) * np.exp(-mean) * (1 + mean * (need - 1))
        spare = min(1 + int(np.ceil(weak + 3 * np.sqrt(weak))), 1 + least // 2)
    return least + spare, spare, need


def _class_signatures(own, gram, docs, c, low, top, percent, found) -> None:
    cuts, spare, need = _cut(low, top, percent)
    pick = docs[own]
    d, g = own[pick], gram[pick]
    part = ((g >> np.uint64(32)) * np.uint64(cuts)) >> np.uint64(32)
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (part[1:] != part[:-1])
    at = np.flatnonzero(new)
    total = np.add.reduceat(mix(g ^ np.uint64(0xA0761D6478BD642F)), at)
    n, dd, pp = np.diff(np.append(at, len(d))), d[at], part[at]
    salt = np.uint64((c + 1) * 0x1000003)
    sig = mix(total + mix(pp * np.uint64(0xE7037ED1A0B428DB) + salt))
    rows = len(docs)
    full = np.bincount(dd, minlength=rows)
    weak = cuts - full + np.bincount(dd[n < need], minlength=rows)
    strong = (n >= need) | (weak[dd] > spare)
    sig, dd_strong = sig[strong], dd[strong]
    ends = np.cumsum(np.bincount(dd_strong, minlength=rows))
    for i in np.flatnonzero(docs):
        own_sigs = sig[(ends[i - 1] if i else 0):ends[i]]
        if weak[i] > spare and full[i] < cuts:
            empty = np.setdiff1d(np.arange(cuts, dtype=np.uint64), pp[dd == i])
            empty = mix(mix(empty * np.uint64(0xE7037ED1A0B428DB) + salt) ^ np.uint64(0x8EBC6AF09C88C6E3))
            own_sigs = np.concatenate([own_sigs, empty])
        found[i].append((int(spare + 1 - weak[i]) if weak[i] <= spare else 1, own_sigs))


def _describe(percent: int, ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(1)):
                rows = len(chunk)
                own, gram = ngram_sets(chunk, ngram)
                bounds = np.searchsorted(own, np.arange(rows + 1))
                run_hi = np.concatenate([[np.uint64(0)], np.cumsum(mix(gram), dtype=np.uint64)])
                run_lo = np.concatenate([[np.uint64(0)], np.cumsum(mix(gram ^ np.uint64(0x589965CC75374CC3)),
                                                                   dtype=np.uint64)])
                key = lambda x: pa.array((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64))
                # a text's first class in its own row, a second one in another
                found = signatures(own, gram, rows, percent)
                text = np.array([i for i, x in enumerate(found) for _ in (x or [0])], dtype=np.int64)
                part = np.array([j for x in found for j, _ in enumerate(x or [0])], dtype=np.int32)
                flat = [y for x in found for y in (x or [(1, np.zeros(0, np.uint64))])]
                ends = np.concatenate([[0], np.cumsum([len(y) for _, y in flat])]).astype(np.int32)
                sigs = np.concatenate([y for _, y in flat]).view(np.int64) if flat else np.zeros(0, np.int64)
                pick = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, rows).take(pick), pa.array(np.diff(bounds)).take(pick),
                     key(run_hi).take(pick), key(run_lo).take(pick), pa.array(part),
                     pa.array([n for n, _ in flat], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(sigs))],
                    names=["id", "n", "hi", "lo", "part", "least", "sigs"])
                at += rows
    return run


class Trie:
    """Sorted sets in a trie with ``STRIDE`` elements to a node, or more where
    few sets have little to share: a trie of few sets is LEVELS high."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        largest = int(self.sizes.max(initial=0))
        self.stride = stride = STRIDE if len(sets) > FEW else max(STRIDE, -(-largest // LEVELS))
        depth = -(-largest // stride)
        self.levels = []
        parent = np.zeros(len(sets), dtype=np.int64)  # node of each set on the level above
        alive = np.arange(len(sets))
        for level in range(depth):
            alive = alive[self.sizes[alive] > level * stride]
            width = np.minimum(self.sizes[alive] - level * stride, stride)
            piece = np.zeros((len(alive), stride), dtype=np.int64) - 1
            for row, s in enumerate(alive):
                piece[row, :width[row]] = sets[s][level * stride:(level + 1) * stride]
            rows = np.concatenate([parent[alive][:, None], piece], axis=1)
            nodes, first, inverse = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            inverse = inverse.ravel()
            order = np.argsort(inverse, kind="stable")
            starts = np.searchsorted(inverse[order], np.arange(len(nodes)))
            sizes = self.sizes[alive[order]]
            self.levels.append({
                "items": nodes[:, 1:], "parent": nodes[:, 0],
                "kids": np.searchsorted(nodes[:, 0], np.arange((self.levels[-1]["items"].shape[0] if level else 1) + 1)),
                "low": np.minimum.reduceat(sizes, starts), "high": np.maximum.reduceat(sizes, starts),
                "end_order": alive[order], "start": starts, "stop": np.append(starts[1:], len(order))})
            parent[alive] = inverse

    def at_once(self) -> int:
        """Queries whose comparison on any level stays within ``AT_ONCE`` elements."""
        return max(1, AT_ONCE // max([1, *(x["items"].size for x in self.levels)]))

    def search(self, queries: list[np.ndarray], percent: int, known=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, set) pairs that link; ``known(query, set)`` marks pairs that
        need not be looked at."""
        stride, sizes = self.stride, np.array([len(q) for q in queries], dtype=np.int64)
        base = int(max([0, *(int(q[-1]) for q in queries if len(q)),
                        *(int(x["items"].max(initial=0)) for x in self.levels)])) + 2
        keys = np.concatenate([q + i * base for i, q in enumerate(queries)]) if len(queries) else np.zeros(0, np.int64)
        starts = np.cumsum(sizes) - sizes
        q, node, seen = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for level, x in enumerate(self.levels):
            count = x["kids"][node + 1] - x["kids"][node]
            entry = np.repeat(np.arange(len(q)), count)
            node = x["kids"][node][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
            q, seen = q[entry], seen[entry]
            low, high = x["low"][node], x["high"][node]
            # size bound before anything is compared
            ok = (100 * np.minimum(sizes[q], high) >= percent * np.maximum(sizes[q], low))
            if known is not None and len(node):
                single = x["stop"][node] - x["start"][node] == 1
                ok &= ~(single & known(q, x["end_order"][x["start"][node]]))
            q, node, seen = q[ok], node[ok], seen[ok]
            if not len(q):
                return
            items = x["items"][node]
            want = items + q[:, None] * base
            at = np.searchsorted(keys, want.ravel()).reshape(want.shape)
            hit = (keys[np.minimum(at, len(keys) - 1)] == want) & (items >= 0)
            seen = seen + hit.sum(axis=1)
            width = (items >= 0).sum(axis=1)
            last = np.arange(len(q)), width - 1
            passed = at[last] + hit[last] - starts[q]  # query elements up to the node's last element
            depth = level * stride + width
            low, high = x["low"][node], x["high"][node]
            most = seen + np.minimum(sizes[q] - passed, high - depth)
            ok = (100 + percent) * most >= percent * (sizes[q] + np.maximum(low, most))
            q, node, seen = q[ok], node[ok], seen[ok]
            # sets that end in the node
            ends = np.flatnonzero(x["low"][node] <= level * stride + width[ok])
            if len(ends):
                n = x["stop"][node[ends]] - x["start"][node[ends]]
                e = np.repeat(ends, n)
                at = x["start"][node[ends]].repeat(n) + np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n)
                s = x["end_order"][at]
                done = self.sizes[s] == (level * stride + width[ok])[e]
                link = done & ((100 + percent) * seen[e] >= percent * (sizes[q[e]] + self.sizes[s]))
                yield q[e][link], s[link]


class Union:
    """Classes of a block pair; labels are kept flat for vector lookups."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            lx, ly = self.label[x], self.label[y]
            if lx != ly:
                self.label[self.label == max(lx, ly)] = min(lx, ly)


def join_block(ids: np.ndarray, sides: np.ndarray, texts: pa.Array, percent: int, ngram: int,
               labels: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect every class of linked sets of a block (side 0 only)
    or a block pair (sides 0 and 1; pairs within a side are left to others);
    sets of one label are connected already."""
    sets = cell_sets(texts, ngram)
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1)
    if 0 < len(right) < len(left):
        # the smaller side, a single pivot for one, goes into the trie, the other is looked up
        left, right = right, left
    queries = right if len(right) else left
    trie, union = Trie([sets[i] for i in left]), Union(len(ids))
    union.label = np.unique(labels, return_inverse=True)[1].astype(np.int64)
    edges = []
    most = min(128, trie.at_once())
    step, at = 1 if len(left) > 4 else most, 0
    while at < len(queries):
        part = queries[at:at + step]
        known = lambda q, s: union.label[part[q]] == union.label[left[s]]  # noqa: E731, B023
        for q, s in trie.search([sets[i] for i in part], percent, known):
            a, b = part[q], left[s]
            new = union.label[a] != union.label[b]
            edges += list(zip(ids[a[new]].tolist(), ids[b[new]].tolist()))
            union.join(a[new], b[new])
        at, step = at + step, min(step * 4, most)
    return edges


def block_links(ids: np.ndarray, sides: np.ndarray, roots: list[list[int]], texts: pa.Array, root: int,
                percent: int, ngram: int) -> list[tuple[int, int]]:
    """Every linked pair (smaller id, larger id) of a block or a block pair,
    but for those that the star of a smaller common root gives."""
    sets = cell_sets(texts, ngram)
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    queries = right if len(right) else left
    trie, stars, pairs = Trie([sets[i] for i in left]), [frozenset(r) for r in roots], set()
    step = min(128, trie.at_once())
    for at in range(0, len(queries), step):
        part = queries[at:at + step]
        for q, s in trie.search([sets[i] for i in part], percent):
            for x, y in zip(part[q].tolist(), left[s].tolist()):
                if ids[x] != ids[y] and min(stars[x] & stars[y]) == root:
                    pairs.add((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
    return sorted(pairs)


def _link_groups(percent: int, ngram: int, count: bool):
    """Per block pair its links, or (id, links) with each other set as often as
    ids have it."""
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        found = block_links(ids, table["side"].to_numpy(), table["roots"].to_pylist(), table["text"].combine_chunks(),
                            table["root"][0].as_py(), percent, ngram)
        if count:
            many, total = dict(zip(ids.tolist(), table["ids"].to_pylist())), {}
            for u, v in found:
                total[u] = total.get(u, 0) + many[v]
                total[v] = total.get(v, 0) + many[u]
            found = sorted(total.items())
        x, y = (pa.array([e[j] for e in found], pa.int64()) for j in (0, 1))
        return pa.table({"id": x, "links": y} if count else {"u": x, "v": y})
    return run


def _join_groups(percent: int, ngram: int):
    def run(table: pa.Table) -> pa.Table:
        ids, sides = table["id"].to_numpy(), table["side"].to_numpy()
        edges = sorted(set(join_block(ids, sides, table["text"].combine_chunks(), percent, ngram,
                                      table["label"].to_numpy())))
        u, v = (pa.array([e[j] for e in edges], pa.int64()) for j in (0, 1))
        return pa.table({"u": u, "v": v})
    return run


def _describe_few(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for chunk in text_chunks(b.column(1)):
                own, gram = ngram_sets(chunk, ngram)
                low = gram < np.uint64((1 << 64) // FEW_PARTS)
                few = (gram[low] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                ends = np.searchsorted(own[low], np.arange(len(chunk) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(chunk)), pa.array(np.bincount(own, minlength=len(chunk)), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(few))], names=["id", "n", "few"])
                at += len(chunk)
    return run


def _may_link(percent: int):
    """Sets of a cell that may link with one of another class: two linked sets
    differ in (100 - p) / (100 + p) of the sum of their sizes at most, and so do
    their n-grams in a part of the hash range."""
    def run(table: pa.Table) -> pa.Table:
        few, n, label = table["few"].combine_chunks(), table["n"].to_numpy(), table["label"].to_numpy()
        side, rows = table["side"].to_numpy(), len(table)
        codes = few.flatten().to_numpy().view(np.uint32).astype(np.int64)
        codes = np.unique(np.repeat(np.arange(rows), np.diff(few.offsets.to_numpy())) << 32 | codes)
        own, code = codes >> 32, codes & 0xFFFFFFFF
        held = np.bincount(own, minlength=rows)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(right) == 1:
            both = np.bincount(own[np.isin(code, code[own == right[0]])], minlength=rows)[left][:, None]
        else:
            right = right if len(right) else left
            both = shared_shingles(own, code, rows, AT_ONCE // 4)[np.ix_(left, right)]
        apart = held[left][:, None] + held[right][None, :] - 2 * both
        hit = ((100 + percent) * apart <= (100 - percent) * (n[left][:, None] + n[right][None, :])) \
            & (n[left] > 0)[:, None] & (n[right] > 0)[None, :] & (label[left][:, None] != label[right][None, :])
        some = np.zeros(rows, dtype=bool)
        some[left] |= hit.any(axis=1)
        some[right] |= hit.any(axis=0)
        return table.select(["key", "id"]).filter(pa.array(some))
    return run


def _shared(rows: DataFrame) -> DataFrame:
    """(sig, root): signatures of at least two sets, with the smallest id."""
    return rows.groupBy("sig").agg(F.min("id").alias("root"), F.max("id").alias("last")) \
        .where("root < last").select("sig", "root")


def _near(sets: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(bucket, id, root, shared): the sets that share a signature with the
    same smallest set, of sets that share enough of them, and how many they
    share.  Two sets link by hundreds of signatures, so all those with one
    smallest set are one bucket."""
    rows = sets.select("id", "part", "least", F.explode("sigs").alias("sig")) \
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    shared = stage(_shared(rows), "join-shared")
    near = maybe_in(rows, F.col("sig"), shared, F.col("sig"))
    near = groups_to_members(near, shared, ["sig"], "salt").where("root IS NOT NULL")
    per_set = Window.partitionBy("id", "part")
    enough = F.count(F.lit(1)).over(per_set) >= F.col("least")
    columns = ["id", "part", "least", "sig", "salt"]
    for _ in range(2):
        # counted again, as signatures may have been shared with sets that dropped out
        near = stage(near.withColumn("enough", enough).where("enough").select(*columns), "join-near")
        near = groups_to_members(near, _shared(near), ["sig"], "salt").where("root IS NOT NULL")
    near = near.groupBy("id", "root").agg(F.count(F.lit(1)).alias("shared"))
    return near.select(F.col("root").alias("bucket"), "id", "root", "shared")


def _blocks(stars: DataFrame) -> DataFrame:
    """(id, root, a, b, side): the block pairs a <= b of its star that a set
    goes to; as side 0 it is in block a, as side 1 in block b."""
    sizes = stars.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where("size > 1") \
        .withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
    keyed = stars.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    placed = groups_to_members(keyed, sizes, ["root"], "salt").where("blocks IS NOT NULL") \
        .withColumn("own", F.pmod(F.xxhash64("id", F.lit(17)), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("own")).alias("a"), F.greatest(k, F.col("own")).alias("b"),
        (k < F.col("own")).cast("int").alias("side")))
    return placed.select("id", "root", F.explode(pairs).alias("p")).select("id", "root", "p.a", "p.b", "p.side")


def _star_texts(docs: DataFrame, stars: DataFrame, id_col: str, text_col: str) -> DataFrame:
    wanted = stars.select("id").distinct()
    return maybe_in(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
                    F.xxhash64("id"), wanted, F.xxhash64("id"))


def _every_link(docs: DataFrame, stars: DataFrame, ids: DataFrame, percent: int, ngram: int,
                count: bool) -> DataFrame:
    """(u, v): every linked pair of distinct sets once, by their smallest ids;
    or (id, links): how many ids have a set that links to the id's."""
    spark = docs.sparkSession
    release(spark)
    known = stars.groupBy("id").agg(F.collect_set("root").alias("roots")).join(ids, "id")
    blocks = staged(spark, _blocks(stars), "join-blocks")
    texts = _star_texts(docs, stars, "id", "text").join(known, "id")
    shipped = texts.join(blocks, "id").select("root", "a", "b", "side", "id", "roots", "ids", "text")
    found = shipped.groupBy("root", "a", "b").applyInArrow(
        _link_groups(percent, ngram, count), "id long, links long" if count else "u long, v long")
    return found.groupBy("id").agg(F.sum("links").alias("links")) if count else found


def _prepared(base: DataFrame, percent: int, ngram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables of the rows' sets, of the distinct sets, and of the buckets."""
    spark = base.sparkSession
    keys = ["hi", "lo"]
    with passing(spark) as stage:
        with small_batches(spark):
            rows = stage(base.mapInArrow(_describe(percent, ngram), "id long, n long, hi long, lo long, part int, "
                                         "least int, sigs array<long>"), "join-sets")
        members = staged(spark, rows.where("part = 0").select("id", "n", *keys), "join-members")
        groups = staged(spark, members.where("n > 0").groupBy(*keys)
                        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows")), "join-groups")
        # one row of signatures for each distinct set: only sets that may be
        # given more than once take part in a join
        again = groups.where("rows > 1 AND rep IS NOT NULL")
        signed = flag_maybe(rows.where("n > 0 AND id IS NOT NULL").select("id", *keys, "part", "least", "sigs"),
                            F.xxhash64(*keys), again, F.xxhash64(*keys), "given_again")
        first = groups.where("rep IS NOT NULL").select(F.col("rep").alias("id"), *keys)
        signs = ["id", "part", "least", "sigs"]
        sets = signed.where("NOT given_again").select(*signs).unionAll(
            signed.where("given_again").join(first, ["id", *keys], "left_semi").select(*signs))
        near = staged(spark, _near(sets, stage), "join-buckets")
    return members, groups, near


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                    percent: int = PERCENT, block: int | None = None) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``, the
    smallest id reachable over links (itself included).

    * null and empty texts have no shingles and link with nothing;
    * texts with fewer than ``ngram`` words have one shingle, all their words;
    * equal sets link; rows that repeat an id are one node;
    * a row without id links only with equal sets (its class is their id);
    * an empty table gives an empty result; other columns are ignored.

    At most ``block`` sets (``pivots.BLOCK``) with ``BLOCK_SHINGLES`` n-grams
    meet in one task at once; smaller numbers hold less memory and ship pivots
    more often.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = ["hi", "lo"]
    members, groups, near = _prepared(base, percent, ngram)
    release(spark)

    with passing(spark) as stage:
        sizes = members.where("n > 0").join(near.select("id").distinct(), "id", "left_semi") \
            .groupBy("id").agg(F.sum("n").alias("size"))
        half = int(members.agg(F.sum("n")).first()[0] or 0) // 2
        texts, sizes = base.where("id IS NOT NULL"), stage(sizes, "join-sizes")
        with small_batches(spark):
            few = stage(maybe_in(texts, F.xxhash64("id"), sizes, F.xxhash64("id"))
                        .mapInArrow(_describe_few(ngram), "id long, n long, few array<int>"), "join-few")
        active = lambda cells: cells.join(few, "id").groupBy("key", "a", "b") \
            .applyInArrow(_may_link(percent), "key long, id long")
        classes = linked_classes(near, texts, _join_groups(percent, ngram), stage, weight=F.col("shared"),
                                 notes=sizes, active=active, block=block, block_size=BLOCK_SHINGLES,
                                 at_once=max(half, TRAVEL_SHINGLES), early=True)
        classes = staged(spark, classes, "join-classes")
    named = groups.join(classes, groups["rep"] == classes["node"], "left") \
        .select(*keys, F.coalesce("component", "rep").alias("class"))
    members = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    out = groups_to_members(members, named, keys, "salt")
    own = F.when(F.col("n") > 0, F.coalesce("class", "id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _ids_of_sets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(hi, lo, id, ids): each distinct set's smallest id and how many have it."""
    many = members.where("n > 0").groupBy("hi", "lo").agg(F.count_distinct("id").alias("ids"))
    return groups.where("rep IS NOT NULL").select("hi", "lo", F.col("rep").alias("id")).join(many, ["hi", "lo"])


def jaccard_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                  percent: int = PERCENT) -> DataFrame:
    """(u, v), u < v: every linked pair of distinct sets once, each set under
    its smallest id.  Grows with the square of a family, as there are so many."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    members, groups, near = _prepared(base, percent, ngram)
    stars = near.select("id", "root").distinct()
    ids = _ids_of_sets(members, groups).groupBy("id").agg(F.sum("ids").alias("ids"))
    return _every_link(base, stars, ids, percent, ngram, count=False)


def jaccard_link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                        percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``n_links``, how many
    other ids it links to, those with an equal set included.

    The cases of ``jaccard_classes`` hold: no shingles, no links; a row without
    id links with the ids of its own set only.  An id given with several texts
    counts for each of its sets.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    members, groups, near = _prepared(base, percent, ngram)
    stars = near.select("id", "root").distinct()
    own = staged(spark, _ids_of_sets(members, groups), "join-ids")
    links = _every_link(base, stars, own.groupBy("id").agg(F.sum("ids").alias("ids")), percent, ngram, count=True)
    sums = own.join(links, "id", "left").select("hi", "lo", "ids", F.coalesce("links", F.lit(0)).alias("links"))
    rows = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    out = groups_to_members(rows, sums, ["hi", "lo"], "salt")
    linked = F.when(F.col("id").isNull(), F.col("ids")).otherwise(F.col("ids") - 1 + F.col("links"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.coalesce(linked, F.lit(0))).otherwise(0).cast("long").alias("n_links"))


def keep_class_heads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                     percent: int = PERCENT, block: int | None = None) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its
    columns; documents without words or id stay.  Only documents that may be
    among those that go take part in a join: texts of the others stay where they are."""
    gone, flag = fresh(docs, "_gone", "_flag")
    drop = jaccard_classes(docs, id_col, text_col, ngram, percent, block) \
        .where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias(gone)).distinct()
    drop = staged(docs.sparkSession, drop, "class-gone")
    known = flag_maybe(docs, F.xxhash64(F.col(id_col).cast("long")), drop, F.xxhash64(F.col(gone).cast("long")), flag)
    maybe = known.where(F.col(flag)).drop(flag)
    return known.where(~F.col(flag)).drop(flag).unionAll(
        maybe.join(drop, maybe[id_col] == drop[gone], "left_anti"))
