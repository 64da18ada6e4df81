"""Linking near-equal documents by the Jaccard likeness of their word shingles.

Equal sets are one node from the start. Two sets that are like enough share a shingle
among the first fifth of each, in any order that all sets use; the order here puts
shingles of heavily used hash buckets last, so that common passages hold few groups
together. The sets that share such a shingle are joined twice by signature trees:

* First by bitmaps alone, about a bit per token, which are small enough to travel to every
  group. Pairs that may link by their bitmaps make families; all links lie inside them.
* Then by the sets themselves, which travel to their family once, or as pairs of blocks when
  the family is large. Pairs that pass the tree are compared exactly.

A node of a tree holds the token bitmaps of its sets combined by OR, the range of their
sizes and how many tokens at most share bits. Two nodes are visited together; the pair is
dropped when the sizes do not allow a link or the bits in common, with the shared ones
added, stay below the least overlap that a link takes. Sets that are connected already are
not compared again, so a group costs about its size and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.runtime import id_and_text, utf8
from millrace.llm.words import WINDOW, mix, shingle_sets
from millrace.operators.joins import free_name
from millrace.session import staged

#: Hash buckets whose use orders the shingles.
BUCKETS = 1 << 15
#: Shingles of buckets that are used this much more than the average are dealt out salted.
HOT_BUCKET = 2_000
SALTS = 32
#: Set keys that a task remembers to send each set once.
REMEMBERED = 500_000
#: Tokens of a block; a larger group is cut into blocks.
BLOCK_TOKENS = 2_000_000
#: Sets of a shingle that are joined in one task at most; more are joined block by block.
GROUP_SETS = 20_000
#: Groups that a task remembers to send each once.
REMEMBERED_GROUPS = 500_000
#: Members of families up to which their list is broadcast, 24 bytes each.
BROADCAST_NODES = 1_000_000

FANOUT = 8
MIN_BITS, MAX_BITS = 64, 8192
PAIRS_AT_ONCE = 1 << 17


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit key of a set, the same for equal sets."""
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


class Links:
    """Union-find over positions; remembers the pairs that joined two parts."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def find(self, k: int) -> int:
        root = k
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[k] != root:
            self.parent[k], k = root, self.parent[k]
        return int(root)

    def join(self, a: int, b: int) -> None:
        a_root, b_root = self.find(a), self.find(b)
        if a_root != b_root:
            self.parent[max(a_root, b_root)] = min(a_root, b_root)
            self.edges.append((a, b))

    def labels(self) -> np.ndarray:
        labels = self.parent
        while True:
            after = labels[labels]
            if (after == labels).all():
                return labels
            labels = after


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection reaches ``percent`` * union; ``a`` and ``b`` are sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def signature_bits(size: int) -> int:
    """Bits of a set's bitmap: the power of two next to its size."""
    return int(min(MAX_BITS, max(MIN_BITS, 1 << round(float(np.log2(size))))))


def signature(tokens: np.ndarray) -> np.ndarray:
    """The bitmap of a set as 64-bit words."""
    bits = signature_bits(len(tokens))
    flags = np.zeros(bits, bool)
    flags[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64)


def _fold(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of more words brought to ``words``; a token keeps its place modulo the bits."""
    return np.bitwise_or.reduce(bitmaps.reshape(len(bitmaps), -1, words), axis=1)


class SignatureTree:
    """Levels of nodes over sets in a given order; level 0 is the sets themselves.

    Inner nodes use bitmaps of the least width among the sets. Sets are compared by the
    smaller width of the two.
    """

    def __init__(self, bitmaps: list[np.ndarray], sizes: np.ndarray):
        self.width = np.array([len(b) for b in bitmaps])
        self.sizes = sizes
        self.row = np.zeros(len(sizes), np.int64)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        own: dict[int, np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            own[w] = np.stack([bitmaps[k] for k in at])
        for w in own:  # all sets of this width or more, at this width
            every = np.zeros((len(sizes), w), np.uint64)
            for wide, maps in own.items():
                if wide >= w:
                    every[self.width == wide] = _fold(maps, w)
            self.folded[w] = (every, sizes - np.bitwise_count(every).sum(axis=1, dtype=np.int64))
        least, excess = self.folded[min(own)]
        self.levels = [(least, sizes, sizes, excess)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, excess = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut, axis=0),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(excess, cut),
                )
            )

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether a pair of nodes can hold a link."""
        bits, low, high, excess = self.levels[level]
        fits = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        # a link needs an overlap of percent / (100 + percent) of both sizes together
        need = percent * (low[a] + low[b])
        if level or len(self.folded) == 1:
            most = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64)
            return fits & ((100 + percent) * (most + np.minimum(excess[a], excess[b])) >= need)
        shared = np.minimum(self.width[a], self.width[b])
        for w, (bits, excess) in self.folded.items():
            at = np.flatnonzero(fits & (shared == w))
            i, j = a[at], b[at]
            most = np.bitwise_count(bits[i] & bits[j]).sum(axis=1, dtype=np.int64)
            fits[at] = (100 + percent) * (most + np.minimum(excess[i], excess[j])) >= need[at]
        return fits

    def candidates(self, links: Links, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets that may link, by dual traversal from the root, a bounded lot at a time."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIRS_AT_ONCE:
                stack.append((level, a[PAIRS_AT_ONCE:], b[PAIRS_AT_ONCE:]))
                a, b = a[:PAIRS_AT_ONCE], b[:PAIRS_AT_ONCE]
            low, high = self._labels(level, links)
            apart = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b = a[apart], b[apart]
            fine = self.possible(level, a, b, percent)
            a, b = a[fine], b[fine]
            if not len(a):
                continue
            if level == 0:
                yield a, b
                continue
            step = np.arange(FANOUT)
            a = np.repeat((a[:, None] * FANOUT + step), FANOUT, axis=1).reshape(-1)
            b = np.tile((b[:, None] * FANOUT + step), (1, FANOUT)).reshape(-1)
            n = len(self.levels[level - 1][1])
            real = (a < n) & (b < n) & ((a < b) if level == 1 else (a <= b))
            stack.append((level - 1, a[real], b[real]))

    def _labels(self, level: int, links: Links) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest component label in every node."""
        labels = links.labels()
        if not level:
            return labels, labels
        cut = np.arange(0, len(labels), FANOUT**level)
        return np.minimum.reduceat(labels, cut), np.maximum.reduceat(labels, cut)


def _join(bitmaps: list[np.ndarray], sizes: np.ndarray, tie: np.ndarray, percent: int, sets: list | None) -> list:
    """Pairs of positions that connect all that may link, or all that link if ``sets`` are given."""
    # like sets next to each other: size class, then what near copies often share
    order = np.lexsort((sizes, tie, np.floor(np.log(sizes) / np.log(1.25))))
    tree = SignatureTree([bitmaps[k] for k in order], sizes[order])
    links = Links(len(order))

    def check(i: int, j: int) -> None:
        if links.find(i) != links.find(j) and (sets is None or linked(sets[order[i]], sets[order[j]], percent)):
            links.join(i, j)

    near = np.arange(len(order) - 1)
    for k in near[tree.possible(0, near, near + 1, percent)].tolist():
        check(k, k + 1)
    for a, b in tree.candidates(links, percent):
        for i, j in zip(a.tolist(), b.tolist()):
            check(i, j)
    return [(int(order[i]), int(order[j])) for i, j in links.edges]


def link_sets(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that link and together connect all that links connect."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    first = np.array([s[0] for s in sets], np.uint64)
    return _join([signature(s) for s in sets], sizes, first, percent, sets)


def link_signatures(bitmaps: list[np.ndarray], sizes: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of positions that together connect all sets that may link by their bitmaps."""
    if len(bitmaps) < 2:
        return []
    return _join(bitmaps, sizes, np.array([b[0] for b in bitmaps], np.uint64), percent, None)


def _index(docs: DataFrame, n: int) -> DataFrame:
    """Per row ``doc_id, n, key``; the bitmap of every set, once a task (``key, n, bits``); and per
    task the use of every bucket (``bucket, used``)."""
    names = ["doc_id", "n", "key", "bits", "bucket", "used"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def rows(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[n], k) if n in columns else pa.nulls(size, k) for n, k in zip(names, kinds)], names=names
        )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, sent = np.zeros(BUCKETS, np.int64), set()
        for batch in batches:
            sets = shingle_sets(*utf8(batch.column(1)), n)
            if sets:
                used += np.bincount((np.concatenate(sets) >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
            keys = [set_key(s) if len(s) else None for s in sets]
            yield rows(doc_id=batch.column(0), n=[len(s) for s in sets], key=keys, used=[0] * len(sets))
            fresh = {}
            for key, own in zip(keys, sets):
                if key is not None and key not in sent:
                    fresh[key] = own
            if len(sent) < REMEMBERED:
                sent.update(fresh)
            yield rows(
                key=list(fresh), n=[len(s) for s in fresh.values()], bits=[signature(s).tobytes() for s in fresh.values()]
            )
        some = np.flatnonzero(used)
        yield rows(bucket=some, used=used[some])

    return docs.mapInArrow(
        measure, "doc_id bigint, n bigint, key bigint, bits binary, bucket int, used bigint"
    )


def _prefixes(docs: DataFrame, used: np.ndarray, n: int, percent: int) -> DataFrame:
    """``token, salt, key``: the first tokens of every set in the common order."""
    hot = used > used.mean() + HOT_BUCKET

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            parts = []
            for shingles in shingle_sets(*utf8(batch.column(1)), n):
                if not len(shingles):
                    continue
                key = set_key(shingles)
                if key in sent:
                    continue
                if len(sent) < REMEMBERED:
                    sent.add(key)
                size = len(shingles)
                first = size - -(-percent * size // 100) + 1
                bucket = (shingles >> np.uint64(49)).astype(np.int64)
                order = np.lexsort((shingles, used[bucket]))[:first]
                salt = np.where(hot[bucket[order]], key % SALTS, -1)
                parts.append((shingles[order], salt, np.full(first, key)))
            if parts:
                token, salt, key = (np.concatenate(c) for c in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(key.astype(np.int64))],
                    names=["token", "salt", "key"],
                )

    return docs.mapInArrow(emit, "token bigint, salt int, key bigint")


def _groups(prefixes: DataFrame) -> DataFrame:
    """``gid, key`` for sets that share a token: a group is a set of sets.

    Tokens with the same sets make the same group, which is told by a hash and sent once by
    a task. Salted tokens and those of very many sets arrive in parts, so they name their
    group by the token.
    """
    none = np.zeros(0, np.int64)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        left: list[np.ndarray] = [none, none.astype(np.int32), none]  # rows of a run that may go on
        going = None  # token and salt of a run of which a part has been sent

        def runs(columns: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal left, going
            token, salt, key = columns
            if not len(token):
                return
            new = np.flatnonzero((token[1:] != token[:-1]) | (salt[1:] != salt[:-1])) + 1
            starts = np.concatenate([[0], new])
            ends = np.append(new, len(token))
            gids, keys = [], []
            # a token of a single set makes no group, unless its run goes on or lies elsewhere too
            look = (ends - starts > 1) | (salt[starts] >= 0)
            look[[0, -1]] = True
            for k in np.flatnonzero(look).tolist():
                low, high = int(starts[k]), int(ends[k])
                open_run = k == len(starts) - 1 and not last
                if open_run and high - low < GROUP_SETS:
                    left = [c[low:high] for c in columns]
                    break
                own = np.unique(key[low:high])
                if salt[low] >= 0 or open_run or going == (token[low], salt[low]):
                    gid = int(token[low])
                    going = (token[low], salt[low])
                else:
                    if len(own) < 2:
                        continue
                    gid = set_key(own.view(np.uint64))
                    if gid in sent:
                        continue
                    if len(sent) < REMEMBERED_GROUPS:
                        sent.add(gid)
                gids.append(np.full(len(own), gid))
                keys.append(own)
                if open_run:
                    left = [c[:0] for c in columns]
            if gids:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in (gids, keys)]
                yield pa.RecordBatch.from_arrays(columns, names=["gid", "key"])

        for batch in batches:
            rows = [np.concatenate([l, batch.column(k).to_numpy()]) for k, l in enumerate(left)]
            left = [c[:0] for c in rows]
            yield from runs(rows, False)
        yield from runs(left, True)

    order = ["token", "salt", "key"]
    dealt = prefixes.select(*order).repartition("token", "salt").sortWithinPartitions(*order)
    return dealt.mapInArrow(find, "gid bigint, key bigint").distinct()


def _families(groups: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of sets that may link to another one by their bitmaps."""
    groups = staged(groups, "groups")
    large = groups.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / GROUP_SETS).cast("int").alias("blocks"))
    large = groups.join(large.where("blocks > 1"), "gid", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    block = F.pmod(F.xxhash64("key"), blocks).cast("int")
    paired = large.select("gid", "key", block.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    paired = paired.select("gid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "key")
    dealt = paired.join(bitmaps, "key").repartition("gid", "i", "j").sortWithinPartitions("gid", "i", "j", "key")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, sizes, bits = None, [], [], []

        def done() -> pa.RecordBatch:
            pairs = link_signatures(bits, np.array(sizes, np.int64), percent)
            a, b = ([keys[p[k]] for p in pairs] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for gid, i, j, key, n, own in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if (gid, i, j) != group:
                    if len(keys) > 1:
                        yield done()
                    keys, sizes, bits = [], [], []
                    group = (gid, i, j)
                if not keys or keys[-1] != key:
                    keys.append(key)
                    sizes.append(n)
                    bits.append(np.frombuffer(own, np.uint64))
        if len(keys) > 1:
            yield done()

    edges = dealt.select("gid", "i", "j", "key", "n", "bits").mapInArrow(join, "a bigint, b bigint")
    return components(edges)


def _links(docs: DataFrame, families: DataFrame, keys: DataFrame, n: int, percent: int, block_tokens: int) -> DataFrame:
    """Links ``a, b`` that connect the sets of every family as all its links do."""
    members = families.join(keys.select(F.col("key").alias("node"), "n"), "node")
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n") / block_tokens).cast("int").alias("blocks"))
    members = staged(members.join(blocks, "root").select(F.col("node").alias("key"), "root", "blocks"), "members")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            out = []
            for shingles in shingle_sets(*utf8(batch.column(1)), n):
                key = set_key(shingles) if len(shingles) else None
                if key is None or key in sent:
                    continue
                if len(sent) < REMEMBERED:
                    sent.add(key)
                out.append((key, shingles.tobytes()))
            if out:
                columns = [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "tokens"])

    small = members.count() <= BROADCAST_NODES
    found = docs.mapInArrow(sets, "key bigint, tokens binary").join(F.broadcast(members) if small else members, "key")
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = found.select("root", "key", "tokens", block.alias("own"), other.alias("other")).select(
        "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "key", "tokens"
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held_keys, held = None, [], []

        def done() -> pa.RecordBatch | None:
            pairs = link_sets(held, percent)
            a, b = ([held_keys[p[k]] for p in pairs] for k in (0, 1))
            held_keys.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for root, i, j, key, tokens in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (root, i, j) != group:
                    if len(held) > 1:
                        yield done()
                    held_keys.clear()
                    held.clear()
                    group = (root, i, j)
                if not held_keys or held_keys[-1] != key:  # equal sets of several tasks
                    held_keys.append(key)
                    held.append(np.frombuffer(tokens, np.uint64))
        if len(held) > 1:
            yield done()

    order = ["root", "i", "j", "key"]
    dealt = dealt.repartition("root", "i", "j").sortWithinPartitions(*order)
    return dealt.select(*order, "tokens").mapInArrow(link, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame,
    percent: int = 80,
    n: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A set is the distinct ``n``-word shingles of the text with A to Z lower-cased; fewer words
    are one shingle. Two rows link when 100 * intersection >= ``percent`` * union of their
    sets; ``component_id`` is the smallest id that links reach. A row without words (null and
    empty texts) links with nothing and has its own id. Rows with equal ids count as rows of
    their own; null ids are never the smallest unless a component has no other. An empty table
    gives no rows. Sets are told apart by 64-bit hashes of shingles and sets.
    """
    own = id_and_text(docs, id_col, text_col)
    index = staged(_index(own, n), "shingle-index")
    used = np.zeros(BUCKETS, np.int64)
    for row in index.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("used").alias("used")).collect():
        used[row.bucket] = row.used
    rows = index.where(F.col("bucket").isNull() & F.col("used").isNotNull()).select("doc_id", "n", "key")
    bitmaps = index.where(F.col("bits").isNotNull()).groupBy("key")
    bitmaps = bitmaps.agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    keys = rows.where(F.col("key").isNotNull()).groupBy("key")
    keys = staged(keys.agg(F.min("doc_id").alias("first"), F.max("n").alias("n")), "shingle-sets")
    families = _families(_groups(_prefixes(own, used, n, percent)), bitmaps, percent)
    links = components(_links(own, families, keys, n, percent, block_tokens))
    whole = keys.join(links.withColumnRenamed("node", "key"), "key")
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    changed = whole.join(least, "root").select("key", "component_id")
    every = staged(
        keys.select("key", F.col("first").alias("component_id")).join(changed.select("key"), "key", "left_anti")
        .unionAll(changed), "component-ids",
    )
    joined = rows.join(every, "key", "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every component, the one with the smallest id, all columns unchanged.

    Rows without words stay. Equal rows become one; other rows that share an id stay as long
    as one of them does. Only ids that go or occur more than once are joined to the texts,
    by broadcast while they are few.
    """
    found = jaccard_components(docs, percent, id_col=id_col, text_col=text_col)
    goes = ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    listed, gone, nth = (free_name(n, set(docs.columns)) for n in ("listed_id", "gone", "nth"))
    per_id = found.groupBy("doc_id").agg(F.bool_and(goes).alias(gone), F.count(F.lit(1)).alias("n"))
    per_id = per_id.where(F.col(gone) | (F.col("n") > 1))
    per_id = staged(per_id.select(F.col("doc_id").alias(listed), gone), "listed-ids")
    if per_id.count() <= BROADCAST_NODES:
        per_id = F.broadcast(per_id)
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(listed))
    single = docs.join(per_id, same, "left_anti")
    repeated = docs.join(per_id.where(~F.col(gone)), same, "left_semi")
    # equal rows are numbered by their JSON, which maps have too
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    equal = Window.partitionBy(F.sha2(whole, 256)).orderBy(F.lit(0))
    first = repeated.withColumn(nth, F.row_number().over(equal)).where(F.col(nth) == 1).drop(nth)
    return single.unionAll(first)
