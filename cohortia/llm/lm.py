"""A hierarchical Pitman-Yor language model over word pairs, learnt from a corpus.

Every word is a context with a restaurant of its own; all of them share one parent, the
restaurant without context, whose base is uniform over the words and one that training
lacks.  Counts of (context, word) are added up over the corpus and seated: given the
parent, the number of tables of each dish is drawn from its Gibbs conditional; given the
tables, which are the parent's customers, the parent is seated the same way.
Probabilities are averages over samples.

No table of words or of dishes is held as a whole.  What is known of a word (its count,
the parent's customers and tables of it, the tables of its own restaurant) lies in
buckets by the word's hash, where its place is that by count; place and bucket are its
id.  Dishes, pairs of ids, lie in buckets by their context's.  The restaurants of
the most frequent words are dealt over all buckets by dish; their parts, and the parent's,
take the others' tables from totals that were added up before.

Texts are read in blocks of some million words.  A block asks the buckets for the ids of
its words, for its dishes that training may have, and for its words, each once; a bucket
of dishes asks for its words likewise.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import (
    pack, pack_sorted, parts_for, scan, stage, unpack, unpack_sorted,
)

VOCABULARY = 4_096  # most frequent words that may have a restaurant in parts
DEALT = 100_000  # customers from which such a restaurant is in parts
BLOCK = 1_000_000  # tokens that share their questions
HELD_WORDS = 300_000  # distinct words that a task counts before it passes them on
ADDED = 0.1  # to the counts of single words
STRENGTH = 1.0  # of a restaurant
PARENT_STRENGTH = 10.0
DISCOUNT = 0.75  # to start with; then estimated
SWEEPS, SAMPLES = 2, 3  # before sampling, and samples
EXACT = 48  # customers up to which the number of tables has its exact conditional
SEED = 77
SHIFT = 32  # bits of a word's place in the key of a dish
END = xxhash.xxh3_64_intdigest(b"\n")  # no word has white space
START = END >> 1  # the end, which is also the context of a text's first word


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case; the end is not among them."""
    return (text or "").encode("utf-8", "replace").lower().split()


def _hash(words) -> np.ndarray:  # noqa: ANN001
    """63-bit hashes of words."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64)
    return (hashes >> np.uint64(1)).astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their sums."""
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def _by_bucket(keys: np.ndarray, bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in ascending order of the keys)."""
    order = np.lexsort((keys, bucket))
    edges = np.searchsorted(bucket[order], np.arange(n + 1))
    for i in range(n):
        if edges[i] < edges[i + 1]:
            yield i, order[edges[i]:edges[i + 1]]


WORDS_SCHEMA = "bucket int, keys binary, counts binary"


def word_counts(docs: DataFrame, parts: int) -> DataFrame:
    """Counts of the words of ``docs`` and of ends, in ``parts`` buckets by hash, staged."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        counted, ends = Counter(), 0

        def flush() -> Iterator[dict[str, list]]:
            keys = np.append(_hash(counted), END >> 1)
            counts = np.append(np.fromiter(counted.values(), np.int64), ends)
            for i, at in _by_bucket(keys, keys % parts, parts):
                yield {"bucket": [i], "keys": [pack_sorted(keys[at])], "counts": [pack(counts[at])]}

        for part in slices:
            for text in part["text"]:
                counted.update(tokens(text))
            ends += len(part["text"])
            if len(counted) > HELD_WORDS:
                yield from flush()
                counted, ends = Counter(), 0
        if ends:
            yield from flush()

    def merge(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for i, rows in _groups(slices, "bucket"):
            keys, counts = _summed(
                [unpack_sorted(row["keys"]) for row in rows], [unpack(row["counts"]) for row in rows])
            yield {"bucket": [i], "keys": [pack_sorted(keys)], "counts": [pack(counts)]}

    counted = scan(docs.select("text"), each, WORDS_SCHEMA)
    dealt = counted.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return stage(scan(dealt, merge, WORDS_SCHEMA))


def _groups(slices: Iterator[dict[str, list]], name: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of consecutive equal ``name`` together."""
    key, rows = None, []
    for part in slices:
        for values in zip(*part.values()):
            row = dict(zip(part, values))
            if row[name] != key and rows:
                yield key, rows
                rows = []
            key = row[name]
            rows.append(row)
    if rows:
        yield key, rows


COUNTED = 1 << 16  # word counts from here on are one class of the count statistics


def _words_by_count(words: DataFrame) -> DataFrame:
    """n, number of words that occur n times (``COUNTED`` and over: one row), their sum."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            for b in part["counts"]:
                counts = unpack(b)
                n, at = np.unique(np.minimum(counts, COUNTED), return_inverse=True)
                yield {
                    "n": n, "kinds": np.bincount(at, counts > 0).astype(np.int64),
                    "total": np.bincount(at, counts).astype(np.int64),
                }

    found = scan(words.select("counts"), each, "n long, kinds long, total long")
    return found.groupBy("n").agg(F.sum("kinds"), F.sum("total"))


@dataclass
class Vocabulary:
    """The most frequent words, by id, and the totals of all words."""

    ids: np.ndarray  # ascending
    counts: np.ndarray
    total: int  # training tokens
    distinct: int

    @classmethod
    def of(cls, words: DataFrame, most: int, parts: int) -> Vocabulary:
        """About ``most`` words: all that are more frequent than some count, and of those
        that have this count the ones of low hash, as many as there is room for."""
        totals, by_count = [0, 0], {}
        for n, kinds, total in _words_by_count(words).collect():
            totals[0] += total
            totals[1] += kinds
            by_count[n] = by_count.get(n, 0) + kinds
        room, least, low = most, 0, 0.0
        for n in sorted(by_count, reverse=True):
            least, low = n, min(1.0, room / by_count[n])
            room -= by_count[n]
            if room <= 0:
                break
        limit = min(int(low * (1 << 63)), (1 << 63) - 1)

        def leading(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
            for part in slices:
                for i, a, b in zip(part["bucket"], part["keys"], part["counts"]):
                    keys, counts = unpack_sorted(a), unpack(b)
                    own = (counts > least) | ((counts == least) & (keys < limit))
                    own &= counts > 0
                    yield {"id": _order(keys, counts)[1][own] * parts + i, "n": counts[own]}

        found = scan(words.select("bucket", "keys", "counts"), leading, "id long, n long").collect()
        rows = sorted((row["id"], row["n"]) for row in found)
        return cls(
            np.array([i for i, _ in rows], np.int64), np.array([n for _, n in rows], np.int64),
            totals[0], totals[1],
        )

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 probability of single words that occur so often."""
        return np.log10((counts + ADDED) / (self.total + ADDED * (self.distinct + 1)))

    @property
    def dealt(self) -> np.ndarray:
        """The contexts whose restaurants are in parts."""
        return self.ids[self.counts >= DEALT]


def _order(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a bucket in the order of their places, most frequent first, and places."""
    order = np.lexsort((keys, -counts))
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return order, places


def _bundle(*arrays: bytes) -> bytes:
    return b"".join(len(data).to_bytes(4, "little") + data for data in arrays)


def _unbundle(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        out.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return out


def _values(data: bytes) -> np.ndarray:
    """A matrix of whole numbers, by row."""
    return np.stack([unpack(row) for row in _unbundle(data)])


def _packed(rows: Iterable[np.ndarray]) -> bytes:
    return _bundle(*[pack(row) for row in rows])


def _pack_dishes(keys: np.ndarray) -> bytes:
    """Dishes, ascending: ids context << SHIFT | word."""
    contexts, n = np.unique(keys >> SHIFT, return_counts=True)
    return _bundle(pack_sorted(contexts), pack(n), pack(keys & LOW))


def _unpack_dishes(data: bytes) -> np.ndarray:
    contexts, n, words = _unbundle(data)
    return np.repeat(unpack_sorted(contexts), unpack(n)) << SHIFT | unpack(words)


LOW = (1 << SHIFT) - 1
DOCS, WORDS, WORD_ANSWER, DISH_ANSWER = range(4)  # kinds of a block's rows
ROWS_SCHEMA = "kind int, block long, bucket int, doc_id long, held boolean, a binary, b binary"
ROW = tuple(name.split()[0] for name in ROWS_SCHEMA.split(", "))


def blocks(docs: DataFrame, parts: int) -> DataFrame:
    """The texts as places in the words of their blocks, and the words; staged.

    ``docs``: doc_id, held, text.  Rows of kind DOCS have a text's words in order (a);
    rows of kind WORDS the hashes (a) and places (b) of a block's words in a bucket.  The
    end has place 0, the others follow by their number in the block.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        task = TaskContext.get().partitionId()
        numbers = count()
        places, texts, held = {}, [], 0

        def close() -> Iterator[dict[str, list]]:
            block = task << 32 | next(numbers)
            hashes, which = np.unique(np.append(START, _hash(places)), return_inverse=True)
            line = np.concatenate([own for _, _, own in texts])
            seen = np.bincount(which[line + 1], minlength=len(hashes))
            seen[which[0]] = held + 1
            _, place = _order(hashes, seen)
            rows = [(DOCS, block, -1, id_, out, pack(place[which[own + 1]]), b"") for id_, out, own in texts]
            for i, own in _by_bucket(hashes, hashes % parts, parts):
                rows.append((WORDS, block, i, None, None, pack_sorted(hashes[own]), pack(place[own])))
            for i in range(0, len(rows), 1000):
                yield dict(zip(ROW, map(list, zip(*rows[i:i + 1000]))))

        for part in slices:
            for id_, out, text in zip(part["doc_id"], part["held"], part["text"]):
                words = tokens(text)
                own = np.empty(len(words), np.int32)
                for i, word in enumerate(words):
                    own[i] = places.setdefault(word, len(places))
                texts.append((id_, out, own))
                held += len(words) + 1
            if held >= BLOCK:
                yield from close()
                places, texts, held = {}, [], 0
        if texts:
            yield from close()

    return stage(scan(docs, each, ROWS_SCHEMA))


def with_ids(rows: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """The blocks' words by id: places in the bucket and one (a; 0: not in training), ascending,
    and places in the block (b).  Staged."""
    both = words.select(
        F.lit(0).alias("kind"), "bucket", F.lit(-1).cast("long").alias("block"),
        F.col("keys").alias("a"), F.col("counts").alias("b"),
    ).union(rows.filter(F.col("kind") == WORDS).select("kind", "bucket", "block", "a", "b"))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        bucket = None
        for part in slices:
            for kind, i, block, a, b in zip(*part.values()):
                if i != bucket:
                    bucket, keys, places = i, np.empty(0, np.int64), np.empty(0, np.int64)
                if not kind:
                    keys, counts = unpack_sorted(a), unpack(b)
                    places = np.where(counts > 0, _order(keys, counts)[1] + 1, 0)
                    continue
                asked = unpack_sorted(a)
                at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
                found = np.where(keys[at] == asked, places[at], 0) if len(keys) else asked * 0
                order = np.argsort(found, kind="stable")
                yield _rows((WORDS, i, block, pack_sorted(found[order]), pack(unpack(b)[order])))

    return stage(scan(_by_key(both, parts), each, BUCKET_SCHEMA))


@dataclass
class Block:
    """A block's texts, and its dishes."""

    texts: list[np.ndarray]
    lengths: np.ndarray  # with the ends
    keys: np.ndarray  # of distinct dishes, places in the block: context << SHIFT | word
    which: np.ndarray  # of them is at each token
    ids: np.ndarray  # keys of those whose words are in training, by id
    asked: np.ndarray  # which those are
    buckets: list[tuple[int, np.ndarray]]  # of ``asked``

    @classmethod
    def of(cls, docs: list[dict], words: list[dict], dealt: np.ndarray, parts: int) -> Block:
        texts = [unpack(row["a"]) for row in docs]
        end = np.zeros(1, np.int64)
        line = np.concatenate([end, *[x for text in texts for x in (text, end)]])
        keys, which = np.unique(line[:-1] << SHIFT | line[1:], return_inverse=True)
        id_ = np.full(sum(len(unpack(row["b"])) for row in words), -1)
        for row in words:
            place = unpack_sorted(row["a"])
            id_[unpack(row["b"])] = np.where(place > 0, (place - 1) * parts + row["bucket"], -1)
        contexts, own = id_[keys >> SHIFT], id_[keys & LOW]
        asked = np.flatnonzero((contexts >= 0) & (own >= 0))
        contexts, own = contexts[asked], own[asked]
        # a context's bucket is its own, or by the word as well if it is dealt
        bucket = (contexts + np.where(np.isin(contexts, dealt), own, 0)) % parts
        ids = contexts << SHIFT | own
        return cls(texts, np.array([len(text) + 1 for text in texts]), keys, which, ids, asked,
                   list(_by_bucket(ids, bucket, parts)))


def _block_dishes(rows: DataFrame, ids: DataFrame, dealt: np.ndarray, parts: int) -> DataFrame:
    """The dishes (a) of the blocks by bucket, and their training counts (b)."""
    spread = rows.sparkSession.sparkContext.broadcast(dealt)

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for block, group in _groups(slices, "block"):
            docs = [row for row in group if row["kind"] == DOCS]
            own = Block.of(docs, [row for row in group if row["kind"] == WORDS], spread.value, parts)
            train = np.repeat([not row["held"] for row in docs], own.lengths)
            counts = np.bincount(own.which[train], minlength=len(own.keys))[own.asked]
            for i, at in own.buckets:
                yield _rows((0, i, block, _pack_dishes(own.ids[at]), pack(counts[at])))

    return scan(_by_block(rows, ids, parts), each, BUCKET_SCHEMA)


def _by_block(rows: DataFrame, more: DataFrame, parts: int) -> DataFrame:
    return rows.filter(F.col("kind") == DOCS).select(*ROW).union(more.select(
        "kind", "block", "bucket", F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("boolean").alias("held"), "a", "b",
    )).repartition(parts, "block").sortWithinPartitions("block", "kind", "bucket", "doc_id")


@dataclass
class Parent:
    """The restaurant without context: samples of its probabilities, and what it needs."""

    probabilities: np.ndarray  # samples x words
    discount: float  # of the contexts


@dataclass
class Mass:
    """What the parent's probabilities need besides a word's own customers and tables."""

    discount: float
    customers: int
    tables: list[int]  # by sample
    kinds: int  # over which the base is uniform

    def probabilities(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """samples x words."""
        mass = PARENT_STRENGTH + self.customers
        back = (PARENT_STRENGTH + self.discount * np.array(self.tables)) / mass
        return np.maximum(customers - self.discount * tables, 0) / mass + back[:, None] / self.kinds


def _parent_tables(customers: np.ndarray, discount: float, kinds: int, outside: float,
                   samples: int, seed: tuple) -> np.ndarray:
    """Samples of the numbers of tables of words in the parent, by row."""
    random = np.random.default_rng(seed)
    base = np.full(len(customers), 1 / kinds)
    zero = np.zeros(len(customers), np.int64)
    tables, out = (customers > 0).astype(np.int64), []
    for i in range(SWEEPS + samples):
        tables = sweep(customers, tables, zero, base, 1, discount, PARENT_STRENGTH, random,
                       np.array([outside]))
        if i >= SWEEPS:
            out.append(tables)
    return np.stack(out)


def seat_parent(customers: np.ndarray, discount: float, *, samples: int = SAMPLES,
                seed: int = SEED) -> Parent:
    """Seat the tables of the contexts as customers of the parent, ``samples`` times."""
    own = estimated_discount(customers)
    tables = _parent_tables(customers, own, len(customers), 0, samples, (seed, 0))
    mass = Mass(own, int(customers.sum()), tables.sum(axis=1).tolist(), len(customers))
    return Parent(mass.probabilities(customers, tables), discount)


def estimated_discount(counts: np.ndarray) -> float:
    """From the numbers of dishes with one and with two customers."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return _discount(once, twice)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else DISCOUNT


def _log_stirling(discount: float, most: int) -> np.ndarray:
    """Logs of the generalised Stirling numbers: seatings of c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for c in range(most):
        for t in range(c + 1):
            stay = out[c, t] + (math.log(c - discount * t) if c > discount * t else -math.inf)
            out[c + 1, t] = np.logaddexp(out[c + 1, t], stay)
            out[c + 1, t + 1] = np.logaddexp(out[c + 1, t + 1], out[c, t])
    return out


def sweep(customers: np.ndarray, tables: np.ndarray, restaurant: np.ndarray, parent: np.ndarray,
          restaurants: int, discount: float, strength: float, random,  # noqa: ANN001
          outside: np.ndarray | None = None) -> np.ndarray:
    """One Gibbs sweep: new numbers of tables for all dishes.

    A dish with c customers has t tables with probability in proportion to S(c, t) times
    the parent's probability to the t times the product of (strength + discount * (tables
    of the others + i)), i < t.  Beyond ``EXACT`` customers, the rest sit down in growing
    groups after those.  Dishes are drawn in four groups, the totals are kept up between.
    ``outside``: tables of each restaurant that are in other parts of it.
    """
    tables = tables.copy()
    log_s = _log_stirling(discount, EXACT)
    for group in range(4):
        mine = np.flatnonzero((customers > 1) & (np.arange(len(customers)) % 4 == group))
        if not len(mine):
            continue
        totals = np.bincount(restaurant, tables, restaurants)
        if outside is not None:
            totals = totals + outside
        others = totals[restaurant[mine]] - tables[mine]
        p, c = parent[mine], customers[mine]
        drawn = np.ones(len(mine), np.int64)
        few = np.minimum(c, EXACT)
        for size in np.unique(few):
            at = np.flatnonzero(few == size)
            for i in range(0, len(at), 20_000):
                rows = at[i:i + 20_000]
                t = np.arange(1, size + 1)
                steps = np.log(strength + discount * (others[rows][:, None] + t - 1)) + np.log(p[rows])[:, None]
                weights = np.cumsum(steps, axis=1) + log_s[size, 1:size + 1]
                weights = np.cumsum(np.exp(weights - weights.max(axis=1, keepdims=True)), axis=1)
                drawn[rows] = 1 + (
                    weights < random.random(len(rows))[:, None] * weights[:, -1:]).sum(axis=1)
        at = np.flatnonzero(c > EXACT)
        seated = np.full(len(at), EXACT)
        while len(at):
            arriving = np.minimum(np.maximum(seated // 8, 1), c[at] - seated)
            new = (strength + discount * (others[at] + drawn[at])) * p[at]
            drawn[at] += random.binomial(arriving, new / (new + seated - discount * drawn[at]))
            seated = seated + arriving
            more = seated < c[at]
            at, seated = at[more], seated[more]
        tables[mine] = drawn
    return tables


def _seated(keys: np.ndarray, customers: np.ndarray, parent: Parent, seed: tuple,
            samples: int, outside: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Samples of the numbers of tables of a bucket's dishes."""
    random = np.random.default_rng(seed)
    _, restaurant = np.unique(keys >> SHIFT, return_inverse=True)
    words = keys & LOW
    most = int(restaurant.max()) + 1
    tables = (customers > 0).astype(np.int64)
    for i in range(SWEEPS + samples):
        p = parent.probabilities[max(i - SWEEPS, 0) % len(parent.probabilities)]
        tables = sweep(customers, tables, restaurant, p[words], most, parent.discount, STRENGTH, random,
                       outside)
        if i >= SWEEPS:
            yield tables


MERGED, WORD_VALUES, AT, ASKED, HOT = range(5)  # kinds of a bucket's rows
BUCKET_SCHEMA = "kind int, bucket int, block long, a binary, b binary"


def _rows(*rows: tuple) -> dict[str, list]:
    return dict(zip(("kind", "bucket", "block", "a", "b"), map(list, zip(*rows))))


def _by_key(rows: DataFrame, parts: int) -> DataFrame:
    return rows.select("kind", "bucket", "block", "a", "b").repartition(
        parts, "bucket").sortWithinPartitions("bucket", "kind", "block")


def merged(asked: DataFrame, parts: int) -> DataFrame:
    """The dishes of the blocks, those of a bucket together; staged.

    MERGED: dishes (a) and customers (b) of a bucket; AT: places in them (a) of a block's
    dishes; ASKED: places and one (a) of its words in a bucket of words, ``block`` is its own.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for i, group in _groups(slices, "bucket"):
            keys, customers = _summed(
                [_unpack_dishes(row["a"]) for row in group], [unpack(row["b"]) for row in group])
            yield _rows((MERGED, i, -1, _pack_dishes(keys), pack(customers)))
            for row in group:
                at = np.searchsorted(keys, _unpack_dishes(row["a"]))
                yield _rows((AT, i, row["block"], pack_sorted(at), b""))
            words = np.unique(keys & LOW)
            for j, at in _by_bucket(words, words % parts, parts):
                yield _rows((ASKED, j, i, pack_sorted(words[at] // parts + 1), b""))

    return stage(scan(_by_key(asked, parts), each, BUCKET_SCHEMA))


def _added(table: DataFrame, more: DataFrame, width: int, parts: int) -> DataFrame:
    """``table`` (bucket, b: values by place), with ``width`` values added up from ``more``."""
    both = table.withColumns({
        "kind": F.lit(0), "block": F.lit(-1).cast("long"), "a": F.lit(b""),
    }).select("kind", "bucket", "block", "a", "b").union(
        more.select(F.lit(1).alias("kind"), "bucket", "block", "a", "b"))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for i, group in _groups(slices, "bucket"):
            own = group[0]["b"]
            sums = np.zeros((width, len(unpack(_unbundle(own)[0]))), np.int64)
            for row in group[1:]:
                sums[:, unpack_sorted(row["a"]) - 1] += _values(row["b"])
            yield _rows((0, i, -1, b"", own + _packed(sums)))

    return stage(scan(_by_key(both, parts), each, BUCKET_SCHEMA))


def seated_words(table: DataFrame, kinds: int, samples: int, seed: int) -> tuple[DataFrame, Mass]:
    """``table`` with the parent's tables of its words, whose customers are its last values.

    The parent is in parts, by bucket: each has the tables of the others from a seating
    before, and at first one for each of their words.
    """

    def customers(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            own = [unpack(_unbundle(b)[-1]) for b in part["b"]]
            yield {"n": [(c > 0).sum() for c in own], "total": [c.sum() for c in own],
                   "once": [(c == 1).sum() for c in own], "twice": [(c == 2).sum() for c in own]}

    names = ("n", "total", "once", "twice")
    sums = scan(table.select("b"), customers, ", ".join(f"{n} long" for n in names)).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    n, discount = sums["n"], _discount(sums["once"], sums["twice"])

    def seats(others: int):  # noqa: ANN202
        def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
            for part in slices:
                for i, b in zip(part["bucket"], part["b"]):
                    c = unpack(_unbundle(b)[-1])
                    outside = others * (1 - int((c > 0).sum()) / max(n, 1))
                    tables = _parent_tables(c, discount, kinds, outside, samples, (seed, i))
                    yield _rows((0, i, -1, b"", b + _packed(tables))) | {
                        f"t{s}": [t.sum()] for s, t in enumerate(tables)}

        schema = BUCKET_SCHEMA + "".join(f", t{s} long" for s in range(samples))
        return stage(scan(table.select("bucket", "b"), each, schema))

    tables = [n]
    for _ in range(2):
        out = seats(tables[0])
        tables = list(out.agg(*[F.coalesce(F.sum(f"t{s}"), F.lit(0)) for s in range(samples)]).first())
    return out.select("bucket", "b"), Mass(discount, sums["total"], tables, kinds)


def answered(table: DataFrame, asked: DataFrame, width: int, parts: int) -> DataFrame:
    """The values of the words that others ask for: ``block`` asked, ``bucket`` answers."""
    both = table.select(F.lit(0).alias("kind"), "bucket", F.lit(-1).cast("long").alias("block"), F.lit(b"").alias("a"), "b").union(
        asked.select(F.lit(1).alias("kind"), "bucket", "block", "a", "b"))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        bucket = None
        for part in slices:
            for kind, i, block, a, b in zip(*part.values()):
                if i != bucket:
                    bucket, values = i, np.zeros((width, 1), np.int64)
                if not kind:
                    values = np.concatenate([values, _values(b)], axis=1)
                    continue
                yield _rows((WORD_VALUES, i, block, b"", _packed(values[:, unpack_sorted(a)])))

    return scan(_by_key(both, parts), each, BUCKET_SCHEMA)


def _dealt_dishes(dishes: DataFrame, dealt: np.ndarray) -> dict[int, int]:
    """Numbers of dishes with customers of the contexts that are in parts."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            for a, b in zip(part["a"], part["b"]):
                contexts, n = np.unique(_unpack_dishes(a)[unpack(b) > 0] >> SHIFT, return_counts=True)
                own = np.isin(contexts, dealt)
                yield {"context": contexts[own], "n": n[own]}

    found = scan(dishes.filter(F.col("kind") == MERGED).select("a", "b"), each, "context long, n long")
    return {row[0]: row[1] for row in found.groupBy("context").agg(F.sum("n")).collect()}


def seated_dishes(dishes: DataFrame, values: DataFrame, mass: Mass, discount: float, number: dict,
                  tables: dict, samples: int, seed: int, parts: int) -> DataFrame:
    """Seat the dishes under the parent; staged.

    ``values``: customers and tables of the words in the parent, last in the answers.
    Contexts in parts have ``number`` dishes and had ``tables`` in all.  Rows: WORD_VALUES
    for the buckets of words, sums of tables (b) of the last sample by word (a); ASKED,
    customers and tables by context; AT, for the blocks; HOT, of the contexts in parts.
    """
    spread = dishes.sparkSession.sparkContext.broadcast((number, tables))
    both = dishes.filter(F.col("kind").isin(MERGED, AT)).union(values.select(
        "kind", F.col("block").cast("int").alias("bucket"), F.col("bucket").cast("long").alias("block"),
        "a", "b"))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        number, known = spread.value
        for i, group in _groups(slices, "bucket"):
            keys, customers = _unpack_dishes(group[0]["a"]), unpack(group[0]["b"])
            contexts, context = np.unique(keys >> SHIFT, return_inverse=True)
            words, word = np.unique(keys & LOW, return_inverse=True)
            keys = context << SHIFT | word
            found = np.concatenate(
                [_values(row["b"]) for row in group if row["kind"] == WORD_VALUES], axis=1)
            own = np.empty_like(found[-1 - len(mass.tables):])
            own[:, np.lexsort((words, words % parts))] = found[-1 - len(mass.tables):]
            parent = Parent(mass.probabilities(own[0], own[1:]), discount)
            has = np.bincount(keys[customers > 0] >> SHIFT, minlength=len(contexts))
            outside = np.zeros(len(contexts))
            for at in np.flatnonzero([c in number for c in contexts.tolist()]):
                c = int(contexts[at])
                outside[at] = known[c] * (1 - has[at] / max(number[c], 1))
            total, by_context = np.zeros(len(keys), np.int64), []
            for t in _seated(keys, customers, parent, (seed, i), samples, outside):
                total += t
                by_context.append(np.bincount(keys >> SHIFT, t, len(contexts)).astype(np.int64))
            if samples == 1:
                sums = np.bincount(keys & LOW, total, len(words)).astype(np.int64)
                for j, at in _by_bucket(words, words % parts, parts):
                    yield _rows((WORD_VALUES, j, i, pack_sorted(words[at] // parts + 1), _packed([sums[at]])))
                hot = np.flatnonzero([c in number for c in contexts.tolist()])
                yield _rows((HOT, i, -1, pack_sorted(contexts[hot]), pack(by_context[0][hot])))
                continue
            for j, at in _by_bucket(contexts, contexts % parts, parts):
                yield _rows((ASKED, j, i, pack_sorted(contexts[at] // parts + 1),
                             _packed([t[at] for t in by_context])))
            for row in group:
                if row["kind"] == AT:
                    at = unpack_sorted(row["a"])
                    yield _rows((AT, i, row["block"], b"", _packed([customers[at], total[at]])))

    return stage(scan(_by_key(both, parts), each, BUCKET_SCHEMA))


def _dealt_tables(seated: DataFrame) -> dict[int, int]:
    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            for a, b in zip(part["a"], part["b"]):
                yield {"context": unpack_sorted(a), "n": unpack(b)}

    found = scan(seated.filter(F.col("kind") == HOT).select("a", "b"), each, "context long, n long")
    return {row[0]: row[1] for row in found.groupBy("context").agg(F.sum("n")).collect()}


def _customer_discount(dishes: DataFrame) -> float:
    """Of the contexts, from the numbers of dishes with one and with two customers."""
    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            own = [unpack(b) for b in part["b"]]
            yield {"once": [(c == 1).sum() for c in own], "twice": [(c == 2).sum() for c in own]}

    found = scan(dishes.filter(F.col("kind") == MERGED).select("b"), each, "once long, twice long")
    return _discount(*found.agg(
        F.coalesce(F.sum("once"), F.lit(0)), F.coalesce(F.sum("twice"), F.lit(0))).first())


@dataclass
class Contexts:
    """Customers of each context and its tables in each sample; zeros if it has none."""

    customers: np.ndarray
    tables: np.ndarray


def log_probabilities(keys_context: np.ndarray, words: np.ndarray, customers: np.ndarray,
                      tables: np.ndarray, contexts: Contexts, parent: Parent) -> np.ndarray:
    """log10 of the averaged predictive probabilities of dishes.

    ``tables``: their sums over the samples.
    """
    mass = STRENGTH + contexts.customers[keys_context]
    out = np.maximum(customers - parent.discount * tables / SAMPLES, 0) / mass
    for s in range(SAMPLES):
        back = (STRENGTH + parent.discount * contexts.tables[s][keys_context]) / mass
        out += back * parent.probabilities[s][words] / SAMPLES
    return np.log10(out)


def scores(docs: DataFrame, *, vocabulary: int = VOCABULARY) -> DataFrame:
    """Score every whole text with a model learnt from those that are not held out.

    ``docs``: doc_id, held (boolean) and text.  Returns doc_id, held_out, n_tokens (words
    and one end), n_known (tokens that training has), train_tokens, base_score (log10,
    single words with 0.1 added to their counts) and score (log10, the model).  A null
    text counts as empty: its only token is the end.  Without training texts all
    probability is uniform.  Repeated rows give repeated rows.

    All words and pairs of words count.  ``vocabulary``: so many of the most frequent words
    may have their restaurant dealt over the buckets.
    """
    docs = docs.select("doc_id", "held", "text")
    parts = parts_for(docs.sparkSession)
    words = word_counts(docs.filter(~F.col("held")), parts)
    v = Vocabulary.of(words, vocabulary, parts)
    kinds = v.distinct + 1 + (v.total == 0)
    rows = blocks(docs, parts)
    ids = with_ids(rows, words, parts)
    dishes = merged(_block_dishes(rows, ids, v.dealt, parts), parts)
    asked = dishes.filter(F.col("kind") == ASKED)
    number = _dealt_dishes(dishes, v.dealt)
    # the contexts under a parent of single words, then the parent under their tables
    counts = _by_place(words)
    first, mass = seated_words(counts, kinds, 1, SEED)
    seated = seated_dishes(
        dishes, answered(first, asked, 2, parts), mass, DISCOUNT, number, number, 1, SEED + 1, parts)
    customers = _added(counts, seated.filter(F.col("kind") == WORD_VALUES), 1, parts)
    table, mass = seated_words(customers, kinds, SAMPLES, SEED + 2)
    discount = _customer_discount(dishes)
    seated = seated_dishes(
        dishes, answered(table, asked, 2 + SAMPLES, parts), mass, discount, number,
        _dealt_tables(seated), SAMPLES, SEED + 3, parts)
    table = _added(table, seated.filter(F.col("kind") == ASKED), SAMPLES, parts)
    replies = answered(table, ids, 2 + 2 * SAMPLES, parts).withColumn("kind", F.lit(WORD_ANSWER)).union(
        seated.filter(F.col("kind") == AT).withColumn("kind", F.lit(DISH_ANSWER)))
    return _block_scores(rows, ids.union(replies), v, mass, discount, parts)


def _by_place(words: DataFrame) -> DataFrame:
    """bucket, b: the counts of its words by place."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            for i, a, b in zip(part["bucket"], part["keys"], part["counts"]):
                counts = unpack(b)
                yield {"bucket": [i], "b": [_packed([counts[_order(unpack_sorted(a), counts)[0]]])]}

    return scan(words, each, "bucket int, b binary")


def _block_scores(rows: DataFrame, more: DataFrame, v: Vocabulary, mass: Mass, discount: float,
                  parts: int) -> DataFrame:
    spread = rows.sparkSession.sparkContext.broadcast((v, v.dealt))

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        v, dealt = spread.value
        for _, group in _groups(slices, "block"):
            of = {kind: [row for row in group if row["kind"] == kind] for kind in range(4)}
            own = Block.of(of[DOCS], of[WORDS], dealt, parts)
            place = np.concatenate([unpack(row["b"]) for row in of[WORDS]])
            values = np.empty((2 + 2 * SAMPLES, len(place)), np.int64)
            values[:, place] = np.concatenate([_values(row["b"]) for row in of[WORD_ANSWER]], axis=1)
            n, parent = values[0], Parent(
                mass.probabilities(values[1], values[2:2 + SAMPLES]), discount)
            contexts = Contexts(n, values[2 + SAMPLES:])
            seats = np.zeros((2, len(own.keys)), np.int64)
            for row, (_, at) in zip(of[DISH_ANSWER], own.buckets):
                seats[:, own.asked[at]] = _values(row["b"])
            words = own.keys & LOW
            logs = log_probabilities(own.keys >> SHIFT, words, seats[0], seats[1], contexts, parent)
            edges = np.cumsum(own.lengths) - own.lengths
            score = np.add.reduceat(logs[own.which], edges)
            base = np.add.reduceat(v.base(n)[words][own.which], edges)
            known = np.add.reduceat((n > 0)[words][own.which].astype(np.int64), edges)
            for i in range(0, len(own.texts), 1000):
                some = slice(i, i + 1000)
                yield {
                    "doc_id": [row["doc_id"] for row in of[DOCS][some]],
                    "held_out": [row["held"] for row in of[DOCS][some]],
                    "n_tokens": own.lengths[some], "n_known": known[some],
                    "train_tokens": [v.total] * len(own.texts[some]),
                    "base_score": base[some], "score": score[some],
                }

    return scan(
        _by_block(rows, more.select("kind", "block", "bucket", "a", "b"), parts), each,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
