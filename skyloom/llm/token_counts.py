"""Exact token counts at every prefix of a text, by dynamic programming over a merge vocabulary.

The last token of a prefix decides its count: count(prefix) = count(prefix without its last token) + 1. A token can
be last where it follows the last token of what stands before it, that is, where merging the two together leaves
exactly these two; one token at most can, for each prefix. So one pass over a text gives the count at every
prefix, and no prefix is ever encoded again: truncation to a budget, or the cost of any prefix, is a lookup.

A merge never spans a place where no vocabulary entry has these two kinds of characters side by side. Texts are cut
there into units (a run of blanks with the letters, or with the other characters, that follow); the table of a
unit does not depend on its neighbours and is kept per worker, so frequent words are solved once.

Counts equal the library's for the whole text (tested), with its default treatment of the text: blanks count as the
word mark, one mark stands before the text, characters outside the vocabulary cost one token per UTF-8 byte.

Defined results: a null or empty text has 0 tokens; texts of any length are read whole; rows are independent, so
repeated rows and other columns do not matter.
"""

from __future__ import annotations

import zlib
from functools import cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import each, fields, query, table

MARK = "▁"
LIMIT = 4096
KEPT_UNITS = 600_000  # tables kept per worker; a full store starts anew
KEPT_PAIRS = 1_000_000
NEVER = 1 << 40
RUNS = regex.compile(rf"{MARK}*\p{{L}}+|{MARK}*[^\p{{L}}{MARK}]+|{MARK}+")
WORDS = regex.compile(rf"{MARK}+[^{MARK}]*|[^{MARK}]+")
RESULT = fields(n_bytes=T.LongType(), n_tokens=T.LongType(), fit_chars=T.LongType())


class PrefixCounter:
    """Token counts at all prefixes for one merge vocabulary, given as piece -> rank."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        if any(MARK in piece.lstrip(MARK) for piece in ranks):
            raise ValueError("vocabulary entries must not continue after a blank")
        mixed = any(len({c.isalpha() for c in piece.lstrip(MARK)}) > 1 for piece in ranks)
        self.units = WORDS if mixed else RUNS
        self.tables: dict[str, tuple[int, bytes]] = {}
        self.pairs: dict[int, bool] = {}
        self.known = frozenset("".join(piece for piece in ranks if len(piece) == 1))
        self.tokens = [piece for piece in ranks if self.merge(piece) == [piece]]
        # All tokens that end at each place of a unit, the longest first.
        self.ends = ahocorasick.Automaton()
        for number, token in enumerate(self.tokens):
            self.ends.add_word(token, (len(token), number))
        if self.tokens:
            self.ends.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Plain merging: the best-ranked adjacent pair first, the leftmost of equals."""
        parts, rank = list(text), self.ranks.get
        gain = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while gain and (best := min(gain)) < NEVER:
            at = gain.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del gain[at]
            if at:
                gain[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
            if at < len(gain):
                gain[at] = rank(parts[at] + parts[at + 1], NEVER)
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Does merging two tokens side by side leave exactly these two?"""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        a, b = self.tokens[left], self.tokens[right]
        found = self.pairs[left << 32 | right] = self.merge(a + b) == [a, b]
        return found

    def solve(self, unit: str) -> tuple[int, bytes]:
        """Tokens of a unit, and the change of the count from each prefix to the next (one signed byte each)."""
        if not self.known.issuperset(unit):
            # No merge reaches a character outside the vocabulary: it stands alone, and so do its two sides.
            parts = regex.split(f"([^{regex.escape(''.join(sorted(set(unit) & self.known)))}])", unit) \
                if set(unit) & self.known else list(unit)
            solved = [(n := len(p.encode()), bytes([n])) if p not in self.known and len(p) == 1 else self.solve(p)
                      for p in parts if p]
            return sum(t[0] for t in solved), b"".join(t[1] for t in solved)
        size_of = len(unit) + 1
        last, count, pairs = [-1] * size_of, [0] * size_of, self.pairs
        for at, (size, token) in self.ends.iter(unit):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                fits = pairs.get(last[start] << 32 | token)
                if not (self.follows(last[start], token) if fits is None else fits):
                    continue
            last[end] = token
            count[end] = count[start] + 1
        return count[-1], bytes([(b - a) & 255 for a, b in zip(count, count[1:])])

    def table_of(self, unit: str) -> tuple[int, bytes]:
        found = self.tables.get(unit)
        if found is None:
            if len(self.tables) >= KEPT_UNITS:
                self.tables.clear()
            found = self.tables[unit] = self.solve(unit)
        return found

    def unit_tables(self, text: str) -> list[tuple[int, bytes]]:
        get, make = self.tables.get, self.table_of
        return [get(u) or make(u) for u in self.units.findall(MARK + text.replace(" ", MARK))]

    def prefixes(self, text: str | None) -> np.ndarray:
        """Counts of the prefixes of 0, 1, ... len(text) code points."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        steps = np.frombuffer(b"".join(t[1] for t in self.unit_tables(text)), dtype=np.int8)
        counts = np.cumsum(steps, dtype=np.int64)
        counts[0] = 0  # the mark before the text stands only if a text follows
        return counts

    def summary(self, text: str | None, limit: int) -> tuple[int, int]:
        """Tokens of the whole text, and code points of its longest prefix of at most ``limit`` tokens."""
        if not text:
            return 0, 0
        tables = self.unit_tables(text)
        total = sum(t[0] for t in tables)
        if total <= limit:
            return total, len(text)
        return total, longest_within(self.prefixes(text), limit)


def longest_within(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens (counts may fall as well as rise)."""
    return int(np.flatnonzero(counts <= limit)[-1])


def pack(counts: np.ndarray) -> bytes:
    """Prefix counts as bytes: changes from one prefix to the next, deflated."""
    return zlib.compress(np.diff(counts).astype(np.int8).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.frombuffer(zlib.decompress(packed), dtype=np.int8), dtype=np.int64)))


@cache
def counter(model_path: str) -> PrefixCounter:
    """The counter of a sentencepiece merge model; made once per worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    order = sorted(ids, key=lambda i: (-model.get_score(i), i))
    return PrefixCounter({model.id_to_piece(i): rank for rank, i in enumerate(order)})


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, fit_chars``: tokens of the whole text and what fits ``limit`` of them."""

    def one(text):
        return (len(text.encode()) if text else 0, *counter(model_path(model)).summary(text, limit))

    return docs.select(F.col(id_col), each(one, RESULT)(F.col(text_col)).alias("m")).select(id_col, "m.*")


def prefix_tables(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, prefixes``: the stored table of every prefix (see ``unpack``)."""

    def one(text):
        counts = counter(model_path(model)).prefixes(text)
        return int(counts[-1]), pack(counts)

    schema = fields(n_tokens=T.LongType(), prefixes=T.BinaryType())
    return docs.select(F.col(id_col), each(one, schema)(F.col(text_col)).alias("m")).select(id_col, "m.*")


def tokens_at(tables: DataFrame, id_col: str, chars_col: str) -> DataFrame:
    """Token count of the prefix of ``chars_col`` code points, from stored tables joined with such a column."""

    def at(packed, chars):
        return [int(unpack(p)[min(max(c, 0), len(unpack(p)) - 1)]) for p, c in zip(packed, chars)]

    def batch(packed, chars):
        import pandas as pd

        return pd.Series(at(packed, chars), dtype="int64")

    from pyspark.sql.functions import pandas_udf

    return tables.select(id_col, chars_col, pandas_udf(batch, T.LongType())("prefixes", chars_col).alias("n_tokens"))


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    found = token_counts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
