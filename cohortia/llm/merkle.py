"""Fingerprints of texts as hash trees over paragraphs and sections.

A text is cut into paragraphs at ends of sentences and lines whose content says so, and
paragraphs into sections likewise, so that an edit changes the cuts around it only.  A
section's digest covers those of its paragraphs, the root those of its sections: equal
roots mean equal texts, and sections that differ lead to the paragraphs that do.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import importable, parts_for, scan

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
WORDS = re.compile(r"\S*\s+|\S+")
LONG = 160  # characters beyond which a sentence is cut at words
ROOT = 16  # bytes of a root
LEAF = 4  # bytes of a paragraph's digest that a fingerprint shows


def _ends(piece: bytes, one_in: int) -> bool:
    return zlib.crc32(piece) % one_in == 0


def _runs(word: str) -> list[str]:
    """A word beyond ``LONG``, such as a line without blanks or encoded data, cut after
    places that the eight characters before them choose, every 32 on average."""
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = np.zeros(len(codes), np.uint64)
    for back in range(8):
        own = np.zeros_like(mixed)
        own[back:] = codes[:len(codes) - back]
        mixed = (mixed + own + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    ends = np.flatnonzero(mixed % np.uint64(32) == 0) + 1
    return [word[a:b] for a, b in zip([0, *ends], [*ends, len(word)]) if a < b]


def paragraphs(text: str) -> list[bytes]:
    """The paragraphs of a text; joined, they are the text."""
    out, open_ = [], []
    for sentence in SENTENCE.findall(text):
        if len(sentence) > LONG:
            pieces = []
            for word in WORDS.findall(sentence):
                if len(word) > LONG:
                    pieces += [(run.encode("utf-8", "replace"), 2) for run in _runs(word)]
                else:
                    pieces.append((word.encode("utf-8", "replace"), 16))
        else:
            pieces = [(sentence.encode("utf-8", "replace"), 2)]
        for piece, one_in in pieces:
            open_.append(piece)
            if piece[-1:] == b"\n" or _ends(piece, one_in):
                out.append(b"".join(open_))
                open_ = []
    if open_:
        out.append(b"".join(open_))
    return out


def fingerprint(text: str | None) -> str:
    """Root, then the sections: ``root/leaf-size.leaf-size/…`` in hexadecimal.

    The fingerprint of an empty or null text is its root alone.
    """
    tree, sections, open_, shown = blake2b(digest_size=ROOT), [], blake2b(digest_size=ROOT), []

    def close() -> None:
        nonlocal open_, shown
        tree.update(open_.digest())
        sections.append(".".join(shown))
        open_, shown = blake2b(digest_size=ROOT), []

    for leaf in paragraphs(text or ""):
        digest = blake2b(leaf, digest_size=ROOT).digest()
        open_.update(digest)
        shown.append(f"{digest[:LEAF].hex()}-{len(leaf):x}")
        if digest[LEAF] % 8 == 0:
            close()
    if shown:
        close()
    return "/".join([tree.hexdigest(), *sections])


def _leaves(print_: str) -> Counter:
    return Counter(leaf for section in print_.split("/")[1:] for leaf in section.split("."))


def _weight(leaves: Counter) -> int:
    return sum(int(leaf.partition("-")[2], 16) * n for leaf, n in leaves.items())


def likeness(one: str, other: str) -> float:
    """Share of both texts, in bytes, in paragraphs that they share; 1 for equal roots."""
    if one.partition("/")[0] == other.partition("/")[0]:
        return 1.0
    mine, theirs = _leaves(one), _leaves(other)
    both = _weight(mine) + _weight(theirs)
    return 2 * _weight(mine & theirs) / both if both else 0.0


def differing(one: str, other: str) -> list[tuple[int, int]]:
    """Byte spans of the first text in paragraphs that the second lacks.

    Sections that both have are passed over without looking at their paragraphs.
    """
    theirs = other.split("/")[1:]
    known, leaves, spans, at = set(theirs), _leaves(other), [], 0
    for section in one.split("/")[1:]:
        for leaf in section.split("."):
            size = int(leaf.partition("-")[2], 16)
            if section not in known and leaf not in leaves:
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + size)
                else:
                    spans.append((at, at + size))
            at += size
    return spans


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text (null: empty)."""

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for rows in slices:
            yield {"doc_id": rows["doc_id"], "fingerprint": [fingerprint(t) for t in rows["text"]]}

    return scan(docs.select("doc_id", "text"), each, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The text with its second half replaced by the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by range of doc_id, descending, each part led on by its next row.

    Columns: part, ahead, doc_id, order, text.  A part holds the rows of its range and,
    with ``ahead``, a copy of those of the first id of the next range, so that each row's
    next is in its part.  Null ids follow all others.  Rows of one id are in the order of
    a hash of their text.
    """
    order = F.xxhash64(F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", "text", order.alias("order"))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else None
    null = F.col("doc_id").isNull()
    bounds = docs.agg(
        F.max("doc_id").alias("most"),
        (F.percentile_approx("doc_id", shares, 20_000) if parts > 1 else F.lit(None)).alias("cuts"),
        F.min(F.when(null, F.col("order"))).alias("null_first"),
    ).first()
    cuts = np.array(sorted({c for c in bounds["cuts"] or [] if c != bounds["most"]}), np.int64)
    most, null_first = bounds["most"], bounds["null_first"]
    ranges = len(cuts) + 1 if most is not None else 0
    last = ranges if null_first is not None else ranges - 1

    importable(docs.sparkSession)

    @F.pandas_udf("array<struct<part:int,ahead:boolean>>")
    def dealt(ids: pd.Series, orders: pd.Series) -> pd.Series:
        out = []
        for id_, order_ in zip(ids.array, orders.array):
            if pd.isna(id_):
                part, first = ranges, order_ == null_first
            else:
                # part 0 has the largest ids; a cut belongs to the part that it begins
                at = int(np.searchsorted(cuts, int(id_), side="left"))
                part = len(cuts) - at
                first = int(id_) == most or (at < len(cuts) and cuts[at] == int(id_))
            rows = [{"part": part, "ahead": False}]
            if first:
                rows.append({"part": part - 1 if part else last, "ahead": True})
            out.append(rows)
        return pd.Series(out)

    id_text = F.col("doc_id").cast("string")  # longs with nulls lose digits in pandas
    return (
        docs.withColumn("to", F.explode(dealt(id_text, F.col("order"))))
        .select("to.part", "to.ahead", "doc_id", "order", "text")
        .repartitionById(max(last + 1, 1), F.col("part"))
        .sortWithinPartitions("part", "ahead", F.desc_nulls_last("doc_id"), "order")
    )


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text, of its edited text, and their likeness.

    The next text is that of the next lower doc_id, after the lowest that of the highest.
    Null texts count as empty; rows without an id follow all others; rows of one id are
    ordered by a hash of their text; a single row is its own next.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held = held_part = None
        for rows in slices:
            out = []
            for part, ahead, id_, text in zip(
                rows["part"], rows["ahead"], rows["doc_id"], rows["text"]
            ):
                text = text or ""
                print_ = fingerprint(text)
                if held and held_part == part:
                    id_before, before, print_before = held
                    edited = edited_text(before, text)
                    edited_print = fingerprint(edited)
                    out.append((
                        id_before, len(before),
                        sha256(edited.encode("utf-8", "replace")).hexdigest(),
                        print_before, edited_print,
                        likeness(print_before, edited_print), likeness(print_before, print_),
                    ))
                held, held_part = None if ahead else (id_, text, print_), part
            if out:
                yield dict(zip(names, map(list, zip(*out))))

    names = (
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
    )
    dealt = with_next(docs, parts_for(docs.sparkSession))
    return scan(
        dealt.select("part", "ahead", "doc_id", "text"), each,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
