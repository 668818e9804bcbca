"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a normal form: lower case, with every run of other than letters and digits as one blank. A test
item of n characters may differ from a passage by an error budget of k = n * ``error_rate`` edits. Cut into k + 1
pieces, at least one piece of any such passage is unchanged. One automaton over all pieces finds exact piece hits in a
document, and Myers' bit-parallel distance verifies every hit. Verification climbs: p neighbouring pieces may have
p - 1 errors, and if they do, one half of them has no more than its own share; so a hit is checked with its neighbour
pieces first, then with twice as many, and few false hits get as far as the whole item. Nothing true is lost.

The test items are a stated query set, read in blocks of about ``BLOCK_CHARS`` characters. Each block is one pass over
the documents, and what it finds is written before the next block is read, so neither driver nor tasks hold more than
one block, however long the benchmark is. A longer single item, and the repeats of one, lie in one block. Documents are
never shuffled.

An item is short if it has fewer than ``MIN_WORDS`` words and fewer than ``MIN_LETTERS`` letters and digits, so a passage
without blanks is measured by its letters. Short items are searched alike, with their own error budget, zero below ten
characters; but what they match begins and ends between words. In scripts without blanks every place is between words.

Defined results: null and empty texts and items match nothing; texts are read whole; repeated rows and repeated items each
give their own result; ties go to the leftmost end.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from skyloom.llm.common import fields, kept_rows, query, table
from skyloom.session import durable

ERROR_RATE = 0.1
MIN_WORDS = 8
MIN_LETTERS = 32
BLOCK_CHARS = 4_000_000
HIT = fields(item_id=T.LongType(), distance=T.IntegerType(), n_errors_allowed=T.IntegerType(), matched=T.StringType())
NOT_WORD = re.compile(r"[\W_]+")
#: Letters of scripts without blanks: Thai, Lao, Tibetan, Burmese, Khmer, kana, Bopomofo and Han.
UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff"
                      "\u3400-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff]")


def normal(text: str | None) -> str:
    return NOT_WORD.sub(" ", text.lower()).strip() if text else ""


def budget(length: int, error_rate: float = ERROR_RATE) -> int:
    return math.floor(length * error_rate + 1e-9)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into ``errors`` + 1 pieces of nearly equal length, with their places."""
    cuts = [round(k * len(item) / (errors + 1)) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def is_short(item: str) -> bool:
    return item.count(" ") + 1 < MIN_WORDS and len(item) - item.count(" ") < MIN_LETTERS


def between_words(plain: str, at: int) -> bool:
    """May a word begin or end at this place of a text in normal form?"""
    beside = plain[max(0, at - 1):at + 1]
    return at in (0, len(plain)) or " " in beside or UNSPACED.search(beside) is not None


def edits(a: str, b: str) -> int:
    """Edit distance of two whole texts."""
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        before, row = row, [k]
        for j, y in enumerate(b):
            row.append(min(before[j] + (x != y), before[j + 1] + 1, row[j] + 1))
    return row[-1]


class Pattern:
    """Bit vectors of an item for Myers' distance; Python's whole numbers hold a pattern of any length."""

    def __init__(self, item: str):
        self.size = len(item)
        self.places: dict[str, int] = {}
        for k, c in enumerate(item):
            self.places[c] = self.places.get(c, 0) | 1 << k
        self.mask, self.top = (1 << self.size) - 1, 1 << (self.size - 1)

    def best(self, text: str, limit: int, enough: int = 0) -> tuple[int, int]:
        """Least distance of the item to any part of ``text`` that is at most ``limit``, and where the first ends.

        (limit + 1, -1) if there is none. Stops early at a distance of ``enough``.
        """
        plus, minus, score, mask, top, get = self.mask, 0, self.size, self.mask, self.top, self.places.get
        least, where = limit + 1, -1
        for k, c in enumerate(text):
            eq = get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph = minus | ~(xh | plus) & mask
            mh = plus & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & mask
            mh = mh << 1 & mask
            plus = mh | ~(xv | ph) & mask
            minus = ph & xv
            if score < least:
                least, where = score, k + 1
                if score <= enough:
                    break
        return least, where


class Matcher:
    """All items of one block, ready to search documents; the automaton is built once per worker."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float = ERROR_RATE):
        self.items, self.error_rate, self.automaton = items, error_rate, None

    def __getstate__(self):
        return {"items": self.items, "error_rate": self.error_rate, "automaton": None}

    def build(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.budgets, self.cuts, self.patterns = [], [], {}
        self.short = {number for number, (_, item) in enumerate(self.items) if is_short(item)}
        for number, (_, item) in enumerate(self.items):
            errors = budget(len(item), self.error_rate)
            parts = pieces(item, errors)
            self.budgets.append(errors)
            self.cuts.append([at for at, _ in parts] + [len(item)])
            for k, (_, piece) in enumerate(parts):
                self.automaton.add_word(piece, self.automaton.get(piece, ()) + ((number, k, *self.beside(number, k)),))
        if len(self.automaton):
            self.automaton.make_automaton()

    def pattern(self, number: int, low: int, high: int) -> Pattern:
        """Pattern of the pieces ``low`` to ``high`` of an item."""
        found = self.patterns.get((number, low, high))
        if found is None:
            cuts = self.cuts[number]
            found = self.patterns[number, low, high] = Pattern(self.items[number][1][cuts[low]:cuts[high]])
        return found

    def groups(self, number: int, piece: int) -> list[tuple[int, int]]:
        """The groups of pieces a piece belongs to, from the whole item down to the smallest."""
        found, low, high = [], 0, len(self.cuts[number]) - 1
        while high - low > 1:
            found.append((low, high))
            middle = (low + high) // 2
            low, high = (low, middle) if piece < middle else (middle, high)
        return found

    def beside(self, number: int, piece: int) -> tuple[int, int, tuple[str, ...]]:
        """What a hit of a piece needs beside it: one of these strings, from and to these places of the item.

        The smallest group of p pieces may have p - 1 errors, all of them in its other pieces; cut into p parts, those
        have one part without an error.
        """
        groups = self.groups(number, piece)
        if not groups:
            return 0, 0, ()
        (low, high), cuts, item = groups[-1], self.cuts[number], self.items[number][1]
        middle = (low + high) // 2
        a, b = (middle, high) if piece < middle else (low, middle)
        if b - a + 1 != high - low:  # the piece shares its half with others: leave it to the verification
            return 0, 0, ()
        errors, other = high - low - 1, item[cuts[a]:cuts[b]]
        return cuts[a] - errors, cuts[b] + errors, tuple(part for _, part in pieces(other, errors))

    def climbs(self, plain: str, number: int, piece: int, start: int) -> bool:
        """Does every group of pieces around a hit, below the whole item, keep within its share of errors?

        ``start`` is where the item would begin if nothing before the piece were inserted or deleted.
        """
        cuts = self.cuts[number]
        for low, high in reversed(self.groups(number, piece)[1:]):
            errors = high - low - 1
            # The piece itself is in place; its group begins and ends within ``errors`` of where it should.
            window = plain[max(0, start + cuts[low] - errors):start + cuts[high] + errors]
            if self.pattern(number, low, high).best(window, errors, errors)[0] > errors:
                return False
        return True

    def search(self, text: str | None) -> list[tuple]:
        """(item_id, distance, errors allowed, matched text) of every item found in ``text``."""
        if self.automaton is None:
            self.build()
        plain = normal(text)
        if not plain:
            return []
        starts: dict[int, set[int]] = {}
        if len(self.automaton):
            for end, owners in self.automaton.iter(plain):
                for number, piece, low, high, parts in owners:
                    start = end + 1 - self.cuts[number][piece + 1]
                    if parts:
                        a, b = max(0, start + low), max(0, start + high)
                        if all(plain.find(part, a, b) < 0 for part in parts):
                            continue
                    if self.climbs(plain, number, piece, start):
                        starts.setdefault(number, set()).add(start)
        found = []
        for number, places in starts.items():
            item_id, item = self.items[number]
            errors = self.budgets[number]
            best, matched = errors + 1, ""
            if number in self.short:
                best, matched = self.whole_words(plain, item, errors, places)
                places = ()
            for low, high in self._windows(sorted(places), len(item), errors, len(plain)):
                distance, end = self.pattern(number, 0, len(self.cuts[number]) - 1).best(plain[low:high], best - 1)
                if distance < best:
                    best, matched = distance, plain[max(0, low + end - len(item)):low + end]
            if best <= errors:
                found.append((item_id, best, errors, matched))
        return sorted(found, key=lambda f: (f[0] is None, f[0] or 0, f[1]))

    @staticmethod
    def whole_words(plain: str, item: str, errors: int, starts: set[int]) -> tuple[int, str]:
        """Least distance of a short item to a part of a text between words, and that part; budget + 1 if too far."""
        best, matched, seen = (errors + 1, 0), "", set()
        firsts = {at for start in starts for at in range(max(0, start - errors), min(len(plain), start + errors) + 1)}
        for first in sorted(firsts):
            if not between_words(plain, first):
                continue
            for end in range(first + len(item) - errors, min(len(plain), first + len(item) + errors) + 1):
                if between_words(plain, end):
                    part = plain[first:end]
                    if part in seen:  # the same part further to the right is no better
                        continue
                    seen.add(part)
                    now = (0 if part == item else edits(item, part), end)
                    if now[0] <= errors and now < best:
                        best, matched = now, part
        return best[0], matched

    @staticmethod
    def _windows(starts: list[int], length: int, errors: int, total: int) -> Iterator[tuple[int, int]]:
        """Where the item could lie, overlapping windows joined."""
        if not starts:
            return
        low, high = max(0, starts[0] - errors), min(total, starts[0] + length + errors)
        for start in starts[1:]:
            a, b = max(0, start - errors), min(total, start + length + errors)
            if a <= high:
                high = max(high, b)
            else:
                yield low, high
                low, high = a, b
        yield low, high


def known_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The query set as ``id, text`` and the number of blocks it is read in."""
    known = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    return known, max(1, math.ceil(total / BLOCK_CHARS))


def item_block(known: DataFrame, blocks: int, block: int) -> list[tuple[int | None, str]]:
    """One block in normal form, about ``BLOCK_CHARS`` characters; equal items share a block."""
    rows = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
    found = sorted(((r["id"], normal(r["text"])) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r for r in found if r[1]]


def _block_column(matcher: Matcher):
    names = HIT.fieldNames()

    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(names, hit)) for hit in matcher.search(t)] for t in texts], dtype=object)

    return pandas_udf(search, T.ArrayType(HIT)).asNondeterministic()  # never run again for a filter on its result


def contamination(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: ``id_col, item_id, distance, n_errors_allowed, matched``."""
    known, blocks = known_items(items)
    parts = []
    for block in range(blocks):
        column = _block_column(Matcher(item_block(known, blocks, block), error_rate))
        found = docs.select(F.col(id_col), column(F.col(text_col)).alias("hits")).select(id_col, F.inline("hits"))
        parts.append(durable(found, "hits") if blocks > 1 else found)
    return reduce(DataFrame.unionAll, parts)


def drop_contaminated(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no item is found; columns stay as they are."""
    known, blocks = known_items(items)
    for block in range(blocks):
        column = _block_column(Matcher(item_block(known, blocks, block), error_rate))
        docs = kept_rows(docs, text_col, column, F.size("m") == 0)
        if block < blocks - 1:
            docs = durable(docs, "clean")
    return docs


@query("op2_decontaminate")
def op2_decontaminate(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
