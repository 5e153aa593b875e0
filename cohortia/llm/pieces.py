"""Encoding to subword pieces and back, one segmentation per distinct marked word.

A marked word is a run of white space marks and the text up to the next mark.  When no
piece of the vocabulary has a mark behind another character, no merge crosses the start
of a marked word, so the ids of a text are the ids of its marked words in order.  Each
task keeps a table of distinct marked words with their ids and their decoded text,
segments a new one once, and joins the ids back by position.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import scan

MARK = "▁"
WORDS_KEPT = 60_000  # distinct words of a table; then the words met before go
PROBE = "ﬁ Ⅷ  a b\tc\r\n　d "


class WordTable:
    """Distinct marked words with ids and decoded text, for one loaded vocabulary."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.mark_id = self.library.piece_to_id(MARK)
        self.plain = frozenset(
            i for i in range(self.library.vocab_size())
            if not (self.library.is_control(i) or self.library.is_unknown(i)
                    or self.library.is_byte(i) or self.library.is_unused(i))
        )
        #: Words can be segmented alone: marks lead their pieces, and text is kept as it is.
        self.separable = (
            not any(MARK in piece.lstrip(MARK) for piece in pieces)
            and self.library.id_to_piece(self.mark_id) == MARK
            and self.library.decode(self.library.encode(PROBE)) == PROBE
        )
        #: Words met lately and those before them: ids as bytes, and text if it differs.
        self.words: dict[str, tuple[bytes, str | None]] = {}
        self.before: dict[str, tuple[bytes, str | None]] = {}

    def rows_of(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """Ids of each text, and the text they decode to."""
        if not self.separable:
            all_ids = self.library.encode(texts, num_threads=1)
            decoded = self.library.decode(all_ids, num_threads=1)
            return [(np.array(ids, np.int32), text) for ids, text in zip(all_ids, decoded)]
        if len(self.words) >= WORDS_KEPT:
            self.words, self.before = {}, self.words
        keys = [marked_words(text) for text in texts]
        self._segment(set().union(*keys))
        out = []
        for own in keys:
            found = [self.words[key] for key in own]
            ids = np.frombuffer(b"".join([row[0] for row in found]), np.int32)
            if any([row[1] is not None for row in found]):
                own = [key if row[1] is None else row[1] for key, row in zip(own, found)]
            out.append((ids, " ".join(own)))
        return out

    def _segment(self, keys: set[str]) -> None:
        """Put the words into the table, segmenting those that it has not met."""
        words, before = self.words, self.before
        keys = keys - words.keys()
        known = keys & before.keys()
        words.update((key, before[key]) for key in known)
        new = list(keys - known)
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            # the library marks the start of what it gets, but gives nothing for nothing
            ids = [found or [self.mark_id] for found in self.library.encode(part, num_threads=1)]
            # plain pieces decode to what they stand for; others need the library
            odd = [i for i, own in enumerate(ids) if not self.plain.issuperset(own)]
            text = dict(zip(odd, self.library.decode([ids[i] for i in odd], num_threads=1)))
            for i, key in enumerate(part):
                words[key] = array("i", ids[i]).tobytes(), text.get(i)


@cache
def word_table(model: str) -> WordTable:
    """The table of this worker; later tasks of the worker go on with it."""
    return WordTable(model)


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first mark; none of an empty text."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    keys = text.split(" ")
    if "" in keys:  # runs of marks belong to the word behind them
        keys = [marked[1:] for marked in re.findall(" +[^ ]*", " " + text)]
    return keys


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every whole text.

    No begin or end ids, no sampling.  A null text counts as empty: no ids, empty text.
    Repeated rows give repeated rows; other columns of ``docs`` are not read.
    """

    def each(slices: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        table = word_table(model)
        for rows in slices:
            pairs = table.rows_of([text or "" for text in rows["text"]])
            yield {
                "doc_id": rows["doc_id"],
                "ids": [ids for ids, _ in pairs],
                "decoded": [text for _, text in pairs],
            }

    return scan(docs.select("doc_id", "text"), each, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
