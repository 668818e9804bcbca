"""Spelling variant grouping with a bit-sliced position index.

Words are letter runs of the texts. Two words are near if they differ by exactly one inserted, deleted or replaced code
point. A word's form is its most frequent near word (ties: the smallest) if that is at least ``RATIO`` times as frequent;
following forms to the last gives its root.

The index holds one bit set per (position, letter): the words with that letter there. A query walks its letters once and
keeps, for all words at a time, the set without an error and the sets with one error so far: aligned (a replaced
letter), shifted up (the word has a letter more) and shifted down (a letter less). Every step is a few ANDs and ORs of
whole sets, taken from the index at the same, the next or the previous position.

An error leaves the first or the last half of the shorter word as it is. So the vocabulary is cut into blocks by the
length of the shorter word and one of its halves, and each block gets an index of its own. A pair is counted in the block
of its first half if that is equal, else in the block of its last half: once. Blocks beyond ``TILE_BITS`` are cut into
tiles of queries and tiles of indexed words, every tile of the one against every tile of the other, so a half that
very many words share costs bounded memory and is spread over tasks. Tasks send one row per word and block, never pairs.

Defined results: null and empty texts have no words; a null id counts as the empty text in the checksum; repeated rows
count again; words of any length are compared whole; ties are broken by code points; other columns do not take part; an
empty table, or one without frequent words, gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import query, table
from skyloom.session import durable

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
DAMAGE = 199
FLUSH = 400_000  # distinct words a task holds before it sends their counts
SLICE = 50_000
TILE_BITS = 1 << 25  # words of a tile times their length
TILE_WORDS = 1 << 16

#: Bytes of Latin-1 that are letters here; everything else separates words.
LETTERS = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def letter_runs(text: str | None) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` as Latin-1, A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(LETTERS).lower().split() if text else []


def damaged(runs: Counter, key: str, one_in: int) -> Counter:
    """Counts of words by run; where the checksum of ``key:run`` is a multiple of ``one_in``, one letter is gone."""
    start = zlib.crc32(f"{key}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int | None = None,
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of at least ``least_length`` letters that occur ``least_count`` times or more."""

    def send(held: Counter) -> Iterator[pa.RecordBatch]:
        items = iter(held.items())
        while part := list(islice(items, SLICE)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w, _ in part]), pa.array([n for _, n in part], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = Counter(r for r in letter_runs(text) if len(r) >= least_length)
                if one_in:
                    runs = damaged(runs, key or "", one_in)
                for word, n in runs.items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > FLUSH:
                    yield from send(held)
                    held.clear()
        yield from send(held)

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class PositionIndex:
    """One bit set per (position, letter) over a list of words; bit k stands for word k."""

    def __init__(self, words: list[str]):
        size = len(words) + 7 >> 3
        found: list[dict[str, bytearray]] = []
        lengths: dict[int, bytearray] = defaultdict(lambda: bytearray(size))
        for k, word in enumerate(words):
            byte, bit = k >> 3, 1 << (k & 7)
            while len(found) < len(word):
                found.append(defaultdict(lambda: bytearray(size)))
            for place, letter in zip(found, word):
                place[letter][byte] |= bit
            lengths[len(word)][byte] |= bit
        self.at = [{c: int.from_bytes(b, "little") for c, b in place.items()} for place in found]
        self.lengths = {n: int.from_bytes(b, "little") for n, b in lengths.items()}
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> tuple[int, int, int]:
        """Sets of words exactly one error away: of equal length, one letter longer, one letter shorter."""
        at, end, nothing = self.at, len(self.at), {}
        exact, aligned, longer, shorter = self.all, 0, 0, 0
        before = nothing
        for i, letter in enumerate(word):
            here = at[i] if i < end else nothing
            after = at[i + 1] if i + 1 < end else nothing
            aligned = aligned & here.get(letter, 0) | exact
            longer = (longer | exact) & after.get(letter, 0)
            shorter = shorter & before.get(letter, 0) | exact
            exact &= here.get(letter, 0)
            if not exact | aligned | longer | shorter:
                return 0, 0, 0
            before = here
        size = self.lengths.get
        n = len(word)
        return (aligned & size(n, 0) & ~exact, (longer | exact) & size(n + 1, 0), shorter & size(n - 1, 0))


def members(bits: int) -> Iterator[int]:
    """Numbers of the bits of a set."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def block_pairs(shorter: int, last_half: bool, rows: list[tuple[str, int, bool, bool]]) -> list[tuple[str, int, int, str]]:
    """Near words per word of one block (or pair of tiles): ``word, n_near, best_n, best``.

    ``rows`` are (word, n, asks, indexed); words of length ``shorter`` ask, these and words one letter longer are indexed.
    """
    indexed = [r for r in rows if r[3]]
    index = PositionIndex([r[0] for r in indexed])
    half = shorter // 2
    out: dict[str, list] = {}

    def add(word: str, n: int, other: str) -> None:
        held = out.setdefault(word, [0, -1, ""])
        held[0] += 1
        if n > held[1] or n == held[1] and other < held[2]:
            held[1:] = n, other

    for word, n, asks, _ in rows:
        if not asks:
            continue
        same, longer, _ = index.near(word)
        for bits, both in ((same, False), (longer, True)):
            for k in members(bits):
                other, m = indexed[k][:2]
                if last_half and other.startswith(word[:half]):
                    continue  # counted in the block of the first half
                add(word, m, other)
                if both:  # a longer word asks in the blocks of its own length only
                    add(other, n, word)
    return [(word, *held) for word, held in out.items()]


PARTS = "word string, n_near long, best_n long, best string"


def _in_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    held: list[tuple] = []

    def send() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*held), kinds)], ["word", "n_near", "best_n", "best"])

    for key, group in groupby(rows, key=itemgetter(0, 1, 2, 3, 4)):
        found = [row[5:] for row in group]
        if len(found) > 1:
            held += block_pairs(key[0], bool(key[1]), found)
        if len(held) > SLICE:
            yield send()
            held = []
    if held:
        yield send()


def near_words(words: DataFrame, tile_bits: int = TILE_BITS, tile_words: int = TILE_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``words(word, n)`` that has a near word."""
    length = F.length("word")
    kinds = []
    for shorter in (length, length - 1):
        half = F.floor(shorter / 2).cast("int")
        kinds += [F.struct(shorter.alias("shorter"), F.lit(0).alias("last_half"), F.left("word", half).alias("part")),
                  F.struct(shorter.alias("shorter"), F.lit(1).alias("last_half"), F.right("word", half).alias("part"))]
    placed = words.select("word", "n", F.explode(F.array(*kinds)).alias("b")).select("b.*", "word", "n")
    block = ["shorter", "last_half", "part"]
    limit = F.greatest(F.lit(1), F.least(F.lit(tile_words), F.floor(F.lit(tile_bits) / F.greatest(F.col("shorter"), F.lit(1)))))
    large = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).select(
        *block, F.ceil(F.col("size") / limit).cast("int").alias("tiles"))
    cut = placed.join(large, block, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own, each = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"), F.sequence(F.lit(0), F.col("tiles") - 1)
    asks = F.length("word") == F.col("shorter")

    def to(i, j, asking, indexed):
        return F.struct(i.alias("i"), j.alias("j"), asking.alias("asks"), indexed.alias("indexed"))

    yes, no = F.lit(True), F.lit(False)
    alone = F.array(to(F.lit(0), F.lit(0), F.col("asks"), yes))
    asked = F.transform(each, lambda k: to(F.col("own"), k, F.col("asks"), k == F.col("own")))
    given = F.transform(F.filter(each, lambda k: k != F.col("own")), lambda k: to(k, F.col("own"), no, yes))
    spread = cut.select(*block, "word", "n", "tiles", own.alias("own"), asks.alias("asks")).select(
        *block, "word", "n", F.explode(F.when(F.col("tiles") == 1, alone).otherwise(F.concat(asked, given))).alias("t")
    ).where("t.asks OR t.indexed")
    keys = [*block, "i", "j"]
    rows = spread.select(*block, "t.i", "t.j", "word", "n", "t.asks", "t.indexed")
    parts = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_in_blocks, PARTS)
    best = F.min(F.struct((-F.col("best_n")).alias("least"), F.col("best").alias("best")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.least")).alias("best_n"), "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms(word, form)``, by doubling: a root is replaced by its own root until none has one.

    Counts grow by a factor with every form, so chains are short and have no rings.
    """
    found = durable(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = durable(found.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not found.where("moved").limit(1).count():
            return found.select("word", "root")
        found = found.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words(word, n)``."""
    words = durable(words, "words")
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    near = durable(near.select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "near")
    last = roots(near.where("form IS NOT NULL"))
    return near.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = rf"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY 1, 2),
summed AS (SELECT run, k, xor(list_reduce(flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)),
    lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1]), 4294967295), 4294967295) AS h FROM counted, tab),
made AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2)
    ELSE run END AS word, k FROM summed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM made WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
cut AS (SELECT word, n, p, substring(word, 1, p - 1) || substring(word, p + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (SELECT a.word AS a, b.word AS b, b.n AS m FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest),
best AS (SELECT a AS word, count(*) AS n_near, max(m) AS top, first(b ORDER BY m DESC, b) AS f FROM near GROUP BY a),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {RATIO} * n THEN f END AS form,
  CASE WHEN top >= {RATIO} * n THEN top END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""


@query("op11_spelling_variants", ORACLE)
def op11_spelling_variants(spark, sf_dir):
    return variants(word_counts(table(spark, sf_dir, "documents"), one_in=DAMAGE))
