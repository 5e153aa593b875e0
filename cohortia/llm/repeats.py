"""Long byte strings that repeat, by run-length indexes of a Burrows-Wheeler transform.

A string of 400 bytes is keyed by the least hash of its 32-byte grams, so equal strings
have equal keys wherever they start.  Consecutive starts of one key make a span of text,
consecutive spans up to the next key of a certain remainder a chunk.  Chunks that occur
twice as a whole repeat, and go on as one that stands for its copies; so do spans that
occur twice as a whole; spans that share their key with other spans
are indexed together, a block of keys at a time: the block's suffixes are sorted, the
Burrows-Wheeler transform is cut into runs, and only at the ends of runs is the match
with the neighbouring suffix measured.  Everywhere else it is one byte shorter than that
of the byte before, so the matching statistics of the block stream from the run ends in
the order of the text.

A key whose spans are more text than a block, as of a line that very many documents hold,
is divided by the least of the same grams under another order, and again; what is still too
much is divided by the strings themselves.  The work stays linear in the text of any key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortia.llm.common import parts_for, scan, stage

LENGTH = 400  # bytes of a string that must not repeat
GRAM = 32  # bytes of a gram, a power of two
BLOCK = 1_000_000  # bytes that are indexed together
CHUNK = 8  # spans of a chunk, on average
MOST = 256  # spans of a chunk
BUCKETS = 1 << 20  # hashes of texts that are told apart before texts move
ORDERS = 3  # orders of grams by which a key is divided before its strings divide it
ROWS = 50_000  # spans that a task holds before it passes them on
_TABLE = np.random.default_rng(400).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """A hash of the gram at every start."""
    h = _TABLE[np.frombuffer(data, np.uint8)]
    width, factor = 1, _BASE
    while 2 * width <= gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = 2 * width, factor * factor & _MASK
    if width < gram:  # two that overlap make a gram of any size
        h = h[:width - gram] * np.uint64(factor) + h[gram - width:]
    return _mixed(h, 0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray, factor: int) -> np.ndarray:
    h = (h ^ h >> np.uint64(29)) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def spans(
    data: bytes, length: int = LENGTH, gram: int = GRAM, order: int = 0
) -> list[tuple[int, int, int, bool]]:
    """(key, first start, last start, many) of each run of starts with one key.

    ``order``: which order of the grams makes one of them the least.
    ``many``: the span has the gram of its key more than once, and may match itself.
    """
    if len(data) < length:
        return []
    h = gram_hashes(data, gram)
    for _ in range(order):
        h = _mixed(h + np.uint64(_BASE), 0x94D049BB133111EB)
    window = length - gram + 1
    least, width = h, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        rest = window - width
        least = np.minimum(least[:-rest], least[rest:])
    cuts = np.flatnonzero(least[1:] != least[:-1]) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [len(least)]]) - 1
    keys = least[first]
    sorted_ = np.sort(h)
    by_key: dict[int, list[int]] = {}
    if (sorted_[1:] == sorted_[:-1]).any():  # some gram repeats
        places = np.flatnonzero(np.isin(h, keys))
        for place, key in zip(places.tolist(), h[places].tolist()):
            by_key.setdefault(key, []).append(place)
    out = []
    for key, a, b in zip(keys.tolist(), first.tolist(), last.tolist()):
        at = by_key.get(key, ())
        out.append((key - (1 << 63), a, b,
                    bisect_left(at, b + window) - bisect_left(at, a) > 1))
    return out


PACKED = 7  # bytes of the first level: nine bits each


def _levels(
    codes: np.ndarray, left: np.ndarray
) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix order of a block, its packed bytes, and ranks of its longer substrings.

    ``codes``: bytes plus 1, and 0 for the end of a span; ``left``: positions from each
    one to the end of its span.  Ends are all different, in order: substrings that run
    into one are equal to no other.  Ranks are of 7, 14, 28, … bytes.
    """
    n = len(codes)
    packed = np.zeros(n, np.int64)
    for i in range(PACKED):
        here = np.zeros(n, np.int64)
        here[:max(n - i, 0)] = codes[i:]
        here[left < i] = 0
        packed = packed << 9 | here
    order = np.argsort(packed)
    sorted_ = packed[order]
    ended = np.flatnonzero(sorted_ & 511 == 0)
    order[ended] = order[ended][np.lexsort((order[ended], sorted_[ended]))]  # ends in order
    new = np.ones(n, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    new[ended] = True
    place, width, levels = np.arange(n), PACKED, []
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    while True:
        # only what is still equal to another is sorted further; no end is in its reach
        place = place[~(new & np.append(new[1:], True))]
        if not len(place):
            break
        levels.append((width, rank))
        at = order[place]
        key = rank[at] * (n + 1) + rank[at + width]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[place] = at
        new = np.ones(len(place), bool)
        new[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, place, 0))
        width *= 2
    return order, packed, levels


def matching_statistics(texts: list[bytes]) -> list[np.ndarray]:
    """For every position of every text, the longest match that starts there and also
    starts at any other position of the texts (within one text each)."""
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    n = int(ends[-1])
    codes = np.zeros(n, np.int64)
    body = np.ones(n, bool)
    body[ends - 1] = False
    codes[body] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    left = np.repeat(ends - 1, sizes) - np.arange(n)
    order, packed, levels = _levels(codes, left)
    # the transform; a span's first byte has no byte before it, and ends every run
    starts = ends - sizes
    before = codes[order - 1]
    first = np.zeros(n, bool)
    first[starts] = True
    apart = np.ones(n + 1, bool)  # a run ends between places i - 1 and i
    apart[1:n] = (before[1:] != before[:-1]) | first[order[1:]] | first[order[:-1]]
    sampled = np.flatnonzero(apart[:n] & (np.arange(n) > 0))
    matches = _match_lengths(order[sampled - 1], order[sampled], packed, levels)
    position = np.arange(n)

    def streamed(at: np.ndarray) -> np.ndarray:
        """Matches known at sampled positions, one less for every byte passed."""
        reach = np.full(n, -1, np.int64)
        reach[at] = matches + at
        sampled_at = np.zeros(n, bool)
        sampled_at[at] = True
        sampled_at[edge] = True
        reach[edge] = edge
        last = np.maximum.accumulate(np.where(sampled_at, position, 0))
        return np.maximum(reach[last] - position, 0)

    edge = order[:1]  # the least suffix has no neighbour before it
    up = streamed(order[sampled])
    edge = order[-1:]
    down = streamed(order[sampled - 1])
    best = np.maximum(up, down)
    return [best[a:b - 1] for a, b in zip(starts.tolist(), ends.tolist())]


def _match_lengths(a: np.ndarray, b: np.ndarray, packed: np.ndarray, levels: list) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b."""
    n = len(packed)
    a, b, found = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for width, rank in reversed(levels):
        inside = (a < n) & (b < n)
        same = inside.copy()
        same[inside] = rank[a[inside]] == rank[b[inside]]
        a[same] += width
        b[same] += width
        found[same] += width
    here, there = packed[np.minimum(a, n - 1)], packed[np.minimum(b, n - 1)]
    equal = (a < n) & (b < n)
    for i in range(PACKED):
        shift = 9 * (PACKED - 1 - i)
        x, y = here >> shift & 511, there >> shift & 511
        equal &= (x == y) & (x > 0)
        found += equal
    return found


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_SPANS = "spans array<struct<key:long,digest:long,first:int,last:int,many:boolean>>"


def chunks(
    data: bytes, found: list[tuple[int, int, int, bool]], length: int, at: int = 0
) -> Iterator[tuple[int, int, int, int, list[tuple[int, int, int, int, bool]]]]:
    """The spans of ``data`` in runs, with the digest, first and last start of each run.

    Runs are cut before keys of remainder 0, so equal text is cut alike, and at ``MOST``
    spans.  ``at`` is where ``data`` starts in its document.
    """
    cuts: list[int] = []
    for i, span in enumerate(found):
        if not cuts or span[0] % CHUNK == 0 or i - cuts[-1] >= MOST:
            cuts.append(i)
    for a, b in zip(cuts, [*cuts[1:], len(found)]):
        first, last = found[a][1], found[b - 1][2]
        whole = xxhash.xxh3_128_intdigest(data[first:last + length])
        own = [
            (key, xxhash.xxh3_64_intdigest(data[i:j + length]) - (1 << 63), at + i, at + j, many)
            for key, i, j, many in found[a:b]
        ]
        yield (whole >> 64) - (1 << 63), (whole & _MASK) - (1 << 63), at + first, at + last, own


def _all_chunks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = ("doc_id", "th", "high", "low", "first", "last", "spans")
        for part in slices:
            out = []
            for id_, th, text in zip(part["doc_id"], part["th"], part["text"]):
                data = (text or "").encode("utf-8", "replace")
                out += [(id_, th, *chunk) for chunk in chunks(data, spans(data, length, gram), length)]
            if out:
                yield dict(zip(names, map(list, zip(*out))))

    return scan(
        docs, each, f"doc_id long, th long, high long, low long, first int, last int, {_SPANS}"
    ).withColumn("times", F.lit(1).cast("long"))


def _distinct_chunks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks that repeat as a whole, and the spans of one chunk of each text.

    The first are the rows of a chunk that other rows hold too; the spans are there as
    often as their chunk.  Rows there ``times`` more than once were found to repeat before.
    """
    groups = stage(rows.groupBy("high", "low").agg(
        F.sum("times").alias("times"),
        F.min(F.struct("doc_id", "th", "first", "last", "spans")).alias("one")))
    whole = rows.filter("times = 1").join(
        groups.filter("times > 1").select("high", "low"), ["high", "low"], "left_semi")
    return whole, groups.select(
        "one.doc_id", "one.th", F.explode("one.spans").alias("s"), "times",
    ).select("doc_id", "th", "s.*", "times")


def _sorted_out(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans that repeat as a whole, and those that are left to compare.

    The first are the rows of a span that other rows hold too, but for rows there ``times``
    more than once: their chunks repeat.  The others are key, digest, n and one occurrence
    of each span.
    """
    groups = rows.groupBy("key", "digest").agg(
        F.sum("times").alias("n"), F.max("many").alias("many"),
        F.min(F.struct("doc_id", "th", "first", "last")).alias("one"))
    keys = groups.groupBy("key").agg(
        F.count("*").alias("kinds"), F.min("n").alias("fewest"), F.max("many").alias("any_many"))
    # of interest: a span that occurs twice, or one that may match another or itself
    keys = keys.filter("kinds > 1 OR fewest > 1 OR any_many")
    groups = stage(groups.join(keys, "key"))
    # a row meets one group at most
    whole = rows.filter("times = 1").join(
        groups.filter("n > 1").select("key", "digest"), ["key", "digest"], "left_semi")
    wanted = groups.filter("fewest = 1 AND (kinds > 1 OR any_many)").select(
        "key", "digest", "n", "one.doc_id", "one.th", "one.first", "one.last")
    return whole, wanted


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, th, text and the spans wanted of it as ``cuts``."""
    by_doc = wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("key", "digest", "n", "first", "last")).alias("cuts"))
    return docs.alias("d").join(
        by_doc.alias("w"), F.expr("d.th = w.th AND d.doc_id <=> w.doc_id")
    ).select("d.doc_id", "d.th", "d.text", "cuts")


def _may_hold(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts without most of those that hold no span wanted, left out where they are read.

    Every task knows the hashes of texts wanted, of which there are ``BUCKETS`` at most.
    """
    bucket = F.pmod("th", F.lit(BUCKETS)).alias("bucket")
    held = F.broadcast(wanted.select(bucket).distinct())
    return docs.select("*", bucket).join(held, "bucket", "left_semi").drop("bucket")


def _divided(docs: DataFrame, wanted: DataFrame, length: int, gram: int, order: int) -> DataFrame:
    """The wanted spans cut at a further key, as rows of chunks there ``times``."""
    names = ("doc_id", "th", "key", "high", "low", "first", "last", "spans", "times")

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        out, held = [], 0
        for part in slices:
            for id_, th, text, cuts in zip(*(part[c] for c in ("doc_id", "th", "text", "cuts"))):
                data = text.encode("utf-8", "replace")
                for c in cuts:
                    span, at = data[c["first"]:c["last"] + length], c["first"]
                    for chunk in chunks(span, spans(span, length, gram, order), length, at):
                        out.append((id_, th, c["key"], *chunk, c["n"]))
                        held += len(chunk[-1])
                        if held >= ROWS:
                            yield dict(zip(names, map(list, zip(*out))))
                            out, held = [], 0
        if out:
            yield dict(zip(names, map(list, zip(*out))))

    rows = scan(
        _with_texts(_may_hold(docs, wanted), wanted), each,
        f"doc_id long, th long, key long, high long, low long, first int, last int, {_SPANS}, times long")
    # rows that repeat id and text give a chunk of theirs once more, not twice as often
    return rows.withColumn(
        "spans", F.transform("spans", lambda s: s.withField("key", F.xxhash64("key", s["key"])))
    ).drop("key").dropDuplicates(["doc_id", "th", "first"])


def _covered_by_index(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, first, end) of the bytes that matches within indexed blocks cover.

    ``wanted``: key, digest, n and one occurrence of each span to index.  A block holds
    whole keys.
    """

    def cut(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = ("doc_id", "th", "key", "digest", "n", "first", "span")
        for part in slices:
            out = []
            for id_, th, text, cuts in zip(*(part[c] for c in ("doc_id", "th", "text", "cuts"))):
                data = text.encode("utf-8", "replace")
                out += [
                    (id_, th, c["key"], c["digest"], c["n"], c["first"],
                     data[c["first"]:c["last"] + length])
                    for c in cuts
                ]
            yield dict(zip(names, map(list, zip(*out))))

    found = scan(
        _with_texts(docs, wanted), cut,
        "doc_id long, th long, key long, digest long, n long, first int, span binary",
    ).repartition(parts_for(docs.sparkSession), "key").sortWithinPartitions("key", "digest")

    def index(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        group, held, last, known = [], 0, None, set()

        def close() -> Iterator[dict[str, list]]:
            out = []
            for row, found in zip(group, matching_statistics([row[4] for row in group])):
                if row[2] == 1:  # spans that occur more often repeat as a whole
                    out += [
                        (row[0], row[1], row[3] + a, row[3] + b - 1 + length)
                        for a, b in _ranges(found >= length)
                    ]
            if out:
                yield dict(zip(("doc_id", "th", "first", "end"), map(list, zip(*out))))

        for part in slices:
            for id_, th, key, digest, n, first, span in zip(*part.values()):
                if held >= BLOCK and last != key:
                    yield from close()
                    group, held, known = [], 0, set()
                last = key
                if (key, digest) not in known:  # a span is there once, though its rows repeat
                    known.add((key, digest))
                    group.append((id_, th, n, first, span))
                    held += len(span)
        if group:
            yield from close()

    return scan(found, index, "doc_id long, th long, first int, end int")


def _merged(cuts: DataFrame) -> DataFrame:
    """Overlapping cuts as one, a document's in order of the text."""
    order = Window.partitionBy("doc_id", "th").orderBy("first")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("first") > F.max("end").over(before), F.lit(True))
    return (
        cuts.withColumn("apart", apart.cast("long"))
        .withColumn("run", F.sum("apart").over(order))
        .groupBy("doc_id", "th", "run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
        .drop("run")
    )


def repeated_bytes(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, th (hash of the text) and cuts: (first, end) of repeated bytes, unmerged.

    A row for each (doc_id, text) with a byte that a ``length``-byte string covers which
    also starts elsewhere, in any row or in the same.  Rows that repeat id and text are
    copies of each other.
    """

    def covered(whole: DataFrame) -> DataFrame:
        return whole.select("doc_id", "th", "first", (F.col("last") + length).alias("end"))

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    copies, rows = _distinct_chunks(stage(_all_chunks(texts, length, gram)))
    whole, wanted = _sorted_out(rows)
    cuts = covered(copies).union(covered(whole))
    for order in range(1, ORDERS + 1):
        # of keys with more text than a block there is at most one for each block of text
        heavy = stage(
            wanted.groupBy("key")
            .agg(F.sum(F.col("last") - F.col("first") + length).alias("size"), F.count("*").alias("kinds"))
            .filter((F.col("size") > BLOCK) & (F.col("kinds") > 1)).select("key"))
        if heavy.isEmpty():
            break
        last = order == ORDERS
        finer = stage(_divided(
            texts, wanted.join(heavy, "key", "left_semi"), length, length if last else gram, order))
        copies, rows = _distinct_chunks(finer)
        whole, left = _sorted_out(rows)
        found = covered(copies).union(covered(whole))
        cuts = cuts.union(_merged(found) if last else found)
        wanted = wanted.join(heavy, "key", "left_anti").select(left.columns).union(left)
    return cuts.union(_covered_by_index(texts, wanted, length)).groupBy("doc_id", "th").agg(
        F.collect_set(F.struct("first", "end")).alias("cuts"))


def without_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, removed (first, end of each removed run of bytes) and kept (the other bytes).

    Null texts count as empty; texts shorter than ``length`` bytes lose nothing.
    Repeated rows give repeated rows.
    """
    cuts = repeated_bytes(docs, length=length, gram=gram)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    joined = texts.alias("d").join(
        cuts.alias("c"), F.expr("d.th = c.th AND d.doc_id <=> c.doc_id"), "left"
    ).select("d.doc_id", "d.text", "cuts")

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for part in slices:
            removed, kept = [], []
            for text, own in zip(part["text"], part["cuts"]):
                data = (text or "").encode("utf-8", "replace")
                runs: list[list[int]] = []
                for first, end in sorted((c["first"], c["end"]) for c in own or []):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([first, end])
                edges = [0, *(x for run in runs for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append([{"first": a, "end": b} for a, b in runs])
            yield {"doc_id": part["doc_id"], "removed": removed, "kept": kept}

    return scan(joined, each, "doc_id long, removed array<struct<first:int,end:int>>, kept binary")


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of rows without repeats."""
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda sum_, r: sum_ + r["end"] - r["first"])
    return rows.select(
        "doc_id", (F.octet_length("kept") + lost).cast("long").alias("n_bytes"),
        lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
