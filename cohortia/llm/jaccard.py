"""Documents joined by the Jaccard overlap of their word shingles (T-occurrence search).

A document with n shingles shares at least T = ceil(share * n) of them with a partner.
Its n inverted lists are divided into short ones, which are merged, and long ones, which
are only probed for what the merge retained.

Over the corpus, the short lists of a document are its n - T + 1 rarest shingles by a
sketch of document frequencies: every partner is in one of them.  Each list is searched
for members that may link by an upper bound of their overlap, from counts of shingles by
hash; what may link makes candidate clusters, without emitting pairs.  Within a cluster, inverted lists of exact length are divided once more: short lists are merged
and counted, documents short of T - L (L long lists) are dropped, long lists are probed,
and the exact overlap decides.  Of the links of a cluster those of a spanning forest are
kept, so copies are not paired up.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.common import arrays, pack, parts_for, scan, stage, unpack, unzipped, zipped
from cohortia.llm.components import Forest, components

WORDS = 3  # of a shingle
PERCENT = 90  # of the union that the intersection reaches
SKETCH_BITS = 21  # log2 of the counters of the frequency sketch: a fixed size
CHUNK = 1 << 16  # counters of a row
CLASSES = 500_000  # that a task remembers
TOGETHER = 1_500_000  # shingles of a block of a cluster
NARROWEST, WIDEST = 16, 4096  # counts of shingles by hash that bound an overlap
LONG = 20_000  # members of a list that are compared; longer lists are chains
PARTS = 1 << 14  # of the lists of a document, whatever the corpus
SKIP = 0.01  # the weight of long lists against short ones
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, ascending; of the whole text if it is shorter."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    with np.errstate(over="ignore"):
        out = np.full(len(found) - width + 1, width, np.uint64)
        for i in range(width):
            out = (out ^ hashes[i:len(found) - width + 1 + i]) * _ODD[i % 3]
            out ^= out >> np.uint64(31)
    return np.unique(out)


def _needed(n: int, percent: int) -> int:
    """Shingles that a document of n shares with a partner at least."""
    return (percent * n + 99) // 100


def _text_hash():  # noqa: ANN202
    return F.xxhash64("text")


DOC, SKETCH = 0, 1  # kinds of described rows


def described(docs: DataFrame, *, words: int = WORDS, bits: int = SKETCH_BITS) -> DataFrame:
    """Rows of kind DOC: doc_id, th (hash of the text), n, c (class of equal sets); and of
    kind SKETCH: a chunk of a task's counts of shingles by the first bits of their hash."""
    chunk = min(CHUNK, 1 << bits)
    names = ("kind", "doc_id", "th", "n", "c", "chunk", "counts")

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        counts = np.zeros(1 << bits, np.uint32)
        for part in slices:
            found = [shingles(text, words) for text in part["text"]]
            at = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)
            counts += np.bincount(at, minlength=1 << bits).astype(np.uint32)
            nothing = [None] * len(found)
            columns = (
                [DOC] * len(found), part["doc_id"], part["th"], [len(own) for own in found],
                [_class(own) for own in found], nothing, nothing,
            )
            yield dict(zip(names, columns))
        for i in range(0, 1 << bits, chunk):
            row = (SKETCH, None, None, None, None, i // chunk, pack(counts[i:i + chunk]))
            yield dict(zip(names, ([value] for value in row)))

    rows = docs.select("doc_id", "text", _text_hash().alias("th"))
    return scan(rows, each, "kind int, doc_id long, th long, n long, c long, chunk int, counts binary")


def _class(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def frequency_sketch(rows: DataFrame, *, bits: int = SKETCH_BITS) -> np.ndarray:
    """Level (log2) of the document frequency by the first bits of a shingle's hash.

    ``2 ** bits`` bytes, whatever the corpus: an order of shingles, never a filter.
    """
    chunk = min(CHUNK, 1 << bits)
    chunks = (1 << bits) // chunk

    def add(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        sums: dict[int, np.ndarray] = {}
        for part in slices:
            for i, counts in zip(part["chunk"], part["counts"]):
                own = sums.setdefault(i, np.zeros(chunk, np.uint64))
                own += unpack(counts).astype(np.uint64)
        for i, own in sums.items():
            yield {"chunk": [i], "levels": [np.log2(own + 1.0).astype(np.uint8).tobytes()]}

    counted = rows.filter(F.col("kind") == SKETCH).select("chunk", "counts").repartition(chunks, "chunk")
    levels = np.zeros(1 << bits, np.uint8)
    for i, own in scan(counted, add, "chunk int, levels binary").collect():
        levels[i * chunk:(i + 1) * chunk] = np.frombuffer(own, np.uint8)
    return levels


def width_of(n: int, percent: int) -> int:
    """Counts of shingles by hash that tell unrelated sets of n apart, a power of two.

    Of unrelated sets, the counts of C cells differ by 1.13 * sqrt(n * C) in all, give or
    take 0.85 * sqrt(n); linked ones differ by 2n * (1 - 2 * share / (1 + share)) at most.
    """
    share = percent / 100
    allowed = 2 * (1 - 2 * share / (1 + share))
    wanted = ((allowed * n**0.5 + 2.5) / 1.13) ** 2
    width = NARROWEST
    while width < min(wanted, WIDEST):
        width *= 2
    return width


def short_lists(docs: DataFrame, levels: np.ndarray, *, words: int, percent: int) -> DataFrame:
    """part, width, c, n, guest, cells and shingles: where the short lists of a document go.

    A row for each part (lists by hash, ``PARTS`` of them) and width with the document's
    shingles there, so that a long document repeats its cells less.  Lists are kept apart by the width of the cells, a byte each, that their
    documents need; a document that may link with a narrower one is a guest there.  Of
    the documents of a class a task shows one.
    """
    spread = docs.sparkSession.sparkContext.broadcast(levels)
    bits = int(levels.size).bit_length() - 1
    names = ("part", "width", "c", "n", "guest", "cells", "shingles")

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        levels, shown = spread.value, set()
        for part in slices:
            out = []
            if len(shown) > CLASSES:
                shown.clear()
            for text in part["text"]:
                own = shingles(text, words)
                n, class_ = len(own), _class(own)
                if not n or class_ in shown:
                    continue
                shown.add(class_)
                rank = levels[(own >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64)
                order = np.argsort(rank << np.uint64(56) | own >> np.uint64(8))
                short = own[order[:n - _needed(n, percent) + 1]]
                to = (short % np.uint64(PARTS)).astype(np.int64)
                short, to = short[np.argsort(to)].view(np.int64), np.sort(to)
                edges = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
                pieces = np.split(short, edges[1:])
                width = width_of(n, percent)
                narrower = width_of(_needed(n, percent), percent)
                while True:
                    counts = np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width)
                    cells = np.minimum(counts, 255).astype(np.uint8).tobytes()
                    guest = width < width_of(n, percent)
                    out += [
                        (p, width, class_, n, guest, cells, piece)
                        for p, piece in zip(to[edges].tolist(), pieces)
                    ]
                    if width == narrower:
                        break
                    width //= 2
            if out:
                yield dict(zip(names, map(list, zip(*out))))

    return scan(
        docs.select("text"), each,
        "part int, width int, c long, n long, guest boolean, cells binary, shingles array<long>")


class Lists:
    """Inverted lists of a block of documents, which are in ascending order of size."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(own) for own in sets], np.int64)
        values, which = np.unique(np.concatenate(sets), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.of = [which[at[i]:at[i + 1]] for i in range(len(sets))]  # lists of a document
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.owners = owner[np.argsort(which, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(values)))])
        self.lengths = np.diff(self.starts)

    def merged(self, lists: np.ndarray) -> np.ndarray:
        """How many of the lists each document is in."""
        parts = [self.owners[self.starts[i]:self.starts[i + 1]] for i in lists]
        return np.bincount(np.concatenate(parts) if parts else [], minlength=len(self.sizes))

    def probed(self, document: int, lists: np.ndarray) -> int:
        """In how many of the (ascending) lists a document is, by binary search."""
        own = self.of[document]
        at = np.minimum(np.searchsorted(own, lists), len(own) - 1)
        return int((own[at] == lists).sum())


def spanning_links(sets: list[np.ndarray], *, percent: int = PERCENT,
                   sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that hold together what the links of all pairs hold together.

    With ``sides``, only pairs of different sides count.
    """
    order = np.argsort([len(own) for own in sets], kind="stable")
    lists = Lists([sets[i] for i in order])
    side = None if sides is None else np.asarray(sides)[order]
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for me in range(1, len(sets)):
        n = int(lists.sizes[me])
        first = int(np.searchsorted(lists.sizes[:me], n * percent / 100 - 1e-9))
        if first == me:
            continue
        mine = lists.of[me]
        mine_by_length = mine[np.argsort(lists.lengths[mine], kind="stable")]
        needed = _needed(n, percent)
        most = int(lists.lengths[mine_by_length[-1]])
        long_ = min(needed - 1, int(needed / (SKIP * log2(most + 1) + 1)))
        short, rest = mine_by_length[:n - long_], np.sort(mine_by_length[n - long_:])
        short = short[lists.lengths[short] > 1]  # in the others there is nobody else
        if not len(short):
            continue
        counts = lists.merged(short)[first:me]
        near = np.flatnonzero(counts >= needed - long_) + first
        if side is not None:
            near = near[side[near] != side[me]]
        near = near[np.argsort(-counts[near - first], kind="stable")]
        overlap = None
        for rank, other in enumerate(near.tolist()):
            if find(other) == find(me):
                continue
            if overlap is None and rank >= 32:  # many to probe: merge the long lists as well
                overlap = lists.merged(rest)
            shared = int(counts[other - first]) + (
                int(overlap[other]) if overlap is not None else lists.probed(other, rest))
            if 100 * shared >= percent * (n + int(lists.sizes[other]) - shared):
                root[find(other)] = find(me)
                links.append((int(order[me]), int(order[other])))
    return links


def _cluster_links(members: DataFrame, docs: DataFrame, *, words: int, percent: int) -> DataFrame:
    """Spanning links (a, b) of the classes of each candidate cluster.

    ``members``: c, n, root, doc_id and th of a document of the class.  A cluster of many
    shingles is cut into blocks, and every pair of blocks is a task of its own.
    """
    sums = members.groupBy("root").agg(F.ceil(F.sum("n") / TOGETHER).alias("blocks"))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    dealt = (
        members.join(sums, "root")
        .withColumn("block", F.pmod(F.xxhash64("c"), "blocks"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("c", "doc_id", "th", "root", "block", i.alias("i"), j.alias("j"))
    )
    texts = docs.select("doc_id", "text", _text_hash().alias("th"))

    def zip_(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            yield {"doc_id": part["doc_id"], "th": part["th"],
                   "zip": [zipped(text or "") for text in part["text"]]}

    zips = scan(texts, zip_, "doc_id long, th long, zip binary")
    sets = (
        dealt.alias("m").join(zips.alias("d"), F.expr("m.th = d.th AND m.doc_id <=> d.doc_id"))
        .select("c", "root", "block", "i", "j", "zip")
        .repartition(parts_for(docs.sparkSession), "root", "i", "j")
        .sortWithinPartitions("root", "i", "j", "c")
    )

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        key, group = None, []

        def close() -> Iterator[dict[str, list]]:
            ids = [c for c, _, _ in group]
            if len(group) > 1:
                sides = None if key[1] == key[2] else np.array([block for _, block, _ in group])
                found = spanning_links(
                    [shingles(unzipped(own), words) for _, _, own in group],
                    percent=percent, sides=sides)
                if found:
                    forest = Forest()
                    forest.link((ids[x], ids[y]) for x, y in found)
                    yield forest.stars()

        for part in slices:
            for c, root, block, i, j, own in zip(
                part["c"], part["root"], part["block"], part["i"], part["j"], part["zip"]
            ):
                if (root, i, j) != key:
                    yield from close()
                    key, group = (root, i, j), []
                if not group or group[-1][0] != c:  # rows that repeat each other
                    group.append((c, block, own))
        yield from close()

    return scan(sets, each, "a long, b long")


class Members:
    """Members of lists: key (list), n, c, guest and cells, by key, n and c."""

    def __init__(self, key, n, c, guest, cells) -> None:  # noqa: ANN001
        self.key, self.n, self.c, self.guest, self.cells = key, n, c, guest, cells

    def __len__(self) -> int:
        return len(self.key)

    def __getitem__(self, at) -> Members:  # noqa: ANN001
        return Members(self.key[at], self.n[at], self.c[at], self.guest[at], self.cells[at])

    def after(self, other: Members | None) -> Members:
        """The members of ``other`` and then these."""
        if other is None:
            return self
        return Members(*(
            np.concatenate([getattr(other, name), getattr(self, name)])
            for name in ("key", "n", "c", "guest", "cells")
        ))


def may_link(n: np.ndarray, cells: np.ndarray, m: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles may link: by an upper bound of their overlap.

    Shingles of different cells differ, so an overlap is at most half of the sum of the
    sizes less the differences of the counts.  Counts that are cut off at 255 raise it.
    """
    both = n + m
    overlap = (both - np.abs(cells - others).sum(axis=1)) // 2
    return (100 * overlap >= percent * (both - overlap)) & (
        100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def list_links(own: Members, cells: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that hold together the members of one list that may link."""
    left, links = np.arange(len(own)), []
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = may_link(own.n[one], cells[one], own.n[left], cells[left], percent)
            if own.guest[one]:  # guests meet each other where they are at home
                near &= ~own.guest[left]
            found = left[near]
            links += [(int(own.c[one]), int(own.c[other])) for other in found]
            frontier += found.tolist()
            left = left[~near]
    return links


def candidate_links(docs: DataFrame, levels: np.ndarray, *, words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """Links (a, b) of classes that hold together all that may link in a short list.

    Of a list of more than ``LONG`` members the neighbours in order of size link if their
    sizes allow it, which holds together whatever may link there.  A task passes on the
    components of what it has read.
    """
    parts = parts_for(docs.sparkSession)
    dealt = short_lists(docs, levels, words=words, percent=percent).repartitionById(
        parts, F.col("part") % parts)
    lists = (
        dealt.select("width", "c", "n", "guest", "cells", F.explode("shingles").alias("shingle"))
        .withColumn("key", F.xxhash64("shingle", "width"))
        .select("key", "n", "c", "guest", "cells")
        .sortWithinPartitions("key", "n", "c")
    )

    def each(batches: Iterator[dict[str, np.ndarray]]) -> Iterator[dict[str, list]]:
        forest, held, chained = Forest(), None, None
        for batch in batches:
            x = Members(*(batch[name] for name in ("key", "n", "c", "guest", "cells"))).after(held)
            if chained is not None:  # a chain goes on to the end of its list
                end = int(np.searchsorted(x.key, chained, side="right"))
                forest.link(_chain(x[:end], percent))
                if end == len(x):
                    held = x[-1:]
                    continue
                x, chained = x[end:], None
            last = int(np.searchsorted(x.key, x.key[-1]))
            forest.link(_in_lists(x[:last], percent))
            held = x[last:]
            if len(held) > LONG:
                forest.link(_chain(held, percent))
                chained, held = int(held.key[-1]), held[-1:]
            if len(forest.above) > CLASSES:
                yield forest.stars()
                forest = Forest()
        if held is not None and chained is None:
            forest.link(_in_lists(held, percent))
        yield forest.stars()

    return arrays(lists, each, "a long, b long")


def _chain(x: Members, percent: int) -> list[tuple[int, int]]:
    """Links of neighbours in order of size whose sizes allow it."""
    near = 100 * x.n[:-1] >= percent * x.n[1:]
    return list(zip(x.c[:-1][near].tolist(), x.c[1:][near].tolist()))


def _in_lists(x: Members, percent: int) -> list[tuple[int, int]]:
    """Links of whole lists."""
    if not len(x):
        return []
    # a class is in a list once, and lists of one are of no use
    x = x[np.concatenate([[True], (x.key[1:] != x.key[:-1]) | (x.c[1:] != x.c[:-1])])]
    alone = np.concatenate([[True], x.key[1:] != x.key[:-1]])
    alone &= np.concatenate([x.key[1:] != x.key[:-1], [True]])
    x = x[~alone]
    if not len(x):
        return []
    starts = np.flatnonzero(np.concatenate([[True], x.key[1:] != x.key[:-1]]))
    sizes = np.diff(np.append(starts, len(x)))
    widths = np.array([len(x.cells[start]) for start in starts.tolist()])
    links: list[tuple[int, int]] = []
    for width in np.unique(widths).tolist():
        two = starts[(sizes == 2) & (widths == width)]
        two = two[~(x.guest[two] & x.guest[two + 1])]
        near = two[may_link(
            x.n[two], _cells(x.cells[two], width), x.n[two + 1], _cells(x.cells[two + 1], width), percent)]
        links += zip(x.c[near].tolist(), x.c[near + 1].tolist())
    for start, size, width in zip(
        starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), widths[sizes > 2].tolist()
    ):
        own = x[start:start + size]
        if size > LONG:
            links += _chain(own, percent)
        else:
            links += list_links(own, _cells(own.cells, width), percent)
    return links


def _cells(packed: np.ndarray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint8).reshape(-1, width).astype(np.int32)


def near_documents(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n_shingles, c, root and component_id of every row of ``docs`` (doc_id, text).

    Documents link when their shingle sets overlap by ``percent`` of the union.  Without
    words (null text, white space) the set is empty, and the row links with nothing and
    is its own component.  component_id is the smallest doc_id that links reach, null if
    all of them are null; rows that repeat an id are rows of their own.  ``c`` is the
    class of rows with equal sets and ``root`` that of all classes that links reach: it
    tells components apart also where two of them hold the same id.
    """
    docs = docs.select("doc_id", "text")
    found = stage(described(docs, words=words))
    levels = frequency_sketch(found)
    rows = found.filter(F.col("kind") == DOC).select("doc_id", "th", "n", "c")
    classes = stage(
        rows.filter("n > 0").groupBy("c").agg(
            F.first("n").alias("n"), F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "th")).alias("one"))
    )
    roots = components(candidate_links(docs, levels, words=words, percent=percent))
    members = roots.join(
        classes.select(F.col("c").alias("node"), "n", "one"), "node"
    ).select(F.col("node").alias("c"), "n", "root", "one.doc_id", "one.th")
    linked = components(stage(_cluster_links(members, docs, words=words, percent=percent)))
    joined = linked.join(classes.select(F.col("c").alias("node"), "least"), "node")
    named = joined.join(joined.groupBy("root").agg(F.min("least").alias("component")), "root")
    known = (
        classes.join(named.select(F.col("node").alias("c"), "root", "component"), "c", "left")
        .select("c", F.coalesce("root", "c").alias("root"),
                F.coalesce("component", "least").alias("component_id"))
    )
    return rows.join(known, "c", "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"), "c", "root",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, all columns, but of each group of near copies only one.

    That of the smallest id stays (of equal ids, that of the smallest text hash), one
    without an id only where all are; texts without words are in no group and stay.
    Groups are what links reach, whatever the ids: unlinked texts under one id all stay.
    """
    found = near_documents(docs, **settings).filter("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))
    stays = found.groupBy("root").agg(first.alias("one")).select("one.doc_id", "one.th").distinct()
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    whole = docs.select(row.alias("row"), "doc_id", "text", F.coalesce(_text_hash(), F.lit(0)).alias("th"))
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = (
        whole.filter(~wordless).alias("w")
        .join(stays.alias("s"), F.expr("w.th = s.th AND w.doc_id <=> s.doc_id"), "left_semi")
        .withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "th").orderBy(F.lit(0))))
        .filter("nth = 1")
    )
    return kept.select("row.*").union(whole.filter(wordless).select("row.*"))
