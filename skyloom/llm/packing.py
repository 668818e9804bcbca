"""Packing token sequences by hierarchical best fit.

Documents become token ids and one separator; only those longer than ``CAPACITY`` are cut, into full pieces and a rest.
Full pieces are sequences of their own. All other pieces are dealt to groups of about ``GROUP`` by a hash; each group
packs its pieces locally, longest first, each into the fullest open bin that it fits. Every piece is at its final place in its
bin then; what follows only joins whole bins, as items, in a tree of groups (``FAN_IN`` become one) by the same rule.

After a round any two bins of a group exceed the capacity together, so at most one of them, the open one, is half empty or
more. In each later round a group meets at most ``FAN_IN`` open bins, and each of them can fill one other bin. So a group
hands on its open bin and its ``FAN_IN * rounds left`` emptiest others, and emits all fuller ones: where an open bin fits
anything, it fits the emptiest. What is handed on does not grow with the data, and no join that the tree could make is lost.

Defined results: a null or empty text is its separator alone; documents of any length are tokenized whole; equal ids and
repeated rows are documents of their own; other columns do not take part; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import query, table
from skyloom.llm.similarity_join import in_groups
from skyloom.session import durable

CAPACITY = 2048
SEPARATOR = 0
GROUP = 250_000  # pieces that a group packs
FAN_IN = 16
KEPT_BYTES = 48 << 20  # pieces and ids kept per worker; a full store starts anew
LONG_PIECE = 64  # longer pieces are encoded each time

#: How the vocabulary parts lower-case text, for ASCII and the letters of Latin-1; blanks are dropped. Every such
#: character is composed already and has one lower-case form. Words with others, or with special tokens, go to the library.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\v\f\ra-z0-9ß-öø-ÿ]+")
OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]|<\\|")
BLANKS = re.compile("[ \t\n\v\f\r]+")


class PieceIds:
    """Token ids of whole texts, with those of frequent pieces (words, digits, marks) kept per worker."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.as_bytes = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.kept: dict[str, bytes] = {}
        self.size = 0

    def split(self, text: str) -> list[str]:
        if not OTHER.search(text):
            return PIECES.findall(text.lower())
        out: list[str] = []
        for word in BLANKS.split(text):
            if OTHER.search(word):
                out.append(word)
            else:
                out += PIECES.findall(word.lower())
        return out

    def encode(self, piece: str) -> bytes:
        if OTHER.search(piece):
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        else:
            if not (piece.isascii() and piece.isprintable()):
                piece = self.as_bytes(piece)[0][0]
            ids = [t.id for t in self.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit numbers."""
        found = self.split(text) if text else []
        if self.size > KEPT_BYTES:
            self.kept, self.size = {}, 0
        kept, out = self.kept, []
        for piece in found:
            ids = kept.get(piece)
            if ids is None:
                ids = self.encode(piece)
                if len(piece) <= LONG_PIECE:
                    kept[piece] = ids
                    self.size += len(piece) + len(ids) + 150
            out.append(ids)
        return b"".join(out)


@cache
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           separator: int = SEPARATOR) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` of every piece of every row, tokenized once."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    end = np.array([separator], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_ids(path)
        for batch in batches:
            rows, cuts = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                data = known.ids(text) + end
                for number, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    rows.append(k)
                    cuts.append((number, at // 4, len(part) // 4, zlib.crc32(part)))
            numbers, starts, lengths, sums = zip(*cuts) if cuts else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each item, longest first into the fullest bin it fits; a bin has the number of its first item."""
    bins, places = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    loads = np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free room
    rooms = 0  # bit r: there is a bin with room r
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            into = free[room].pop()
            if not free[room]:
                rooms ^= 1 << room
        else:
            room, into = capacity, k
        bins[k], places[k] = into, capacity - room
        loads[into] += size
        room -= size
        if room:
            free[room].append(into)
            rooms |= 1 << room
    return bins, places, loads


def handed_on(loads: np.ndarray, capacity: int, others: int) -> np.ndarray:
    """Numbers of the bins that a group hands on: the open one and the ``others`` emptiest that have room."""
    some = np.flatnonzero((loads > 0) & (loads < capacity))
    return some[np.argsort(loads[some], kind="stable")][:others + 1]


def rounds_for(groups: int, fan_in: int = FAN_IN) -> int:
    rounds = 0
    while groups > 1:
        groups, rounds = -(-groups // fan_in), rounds + 1
    return rounds


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, fan_in: int = FAN_IN) -> DataFrame:
    """``items`` (with a ``length`` from 1 to ``capacity``) and their ``sequence_id`` and ``offset``."""
    names = items.columns
    rows = durable(items.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("length").cast("long").alias("size"),
                                F.monotonically_increasing_id().alias("uid")), "pieces")
    groups = max(1, -(-rows.where(F.col("size") < capacity).count() // group))
    left = rounds_for(groups, fan_in)
    kept = fan_in * left
    dealt = rows.where(F.col("size") < capacity).withColumn("g", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int"))
    placed_schema = T.StructType([
        T.StructField("g", T.IntegerType()), T.StructField("uid", T.LongType()), T.StructField("bin", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("load", T.LongType())])

    def place(key, part: pd.DataFrame) -> pd.DataFrame:
        uids, lengths = part["uid"].to_numpy(), part["size"].to_numpy()
        order = np.argsort(uids)  # results do not depend on the order of arrival
        uids, lengths = uids[order], lengths[order]
        bins, places, loads = best_fit(lengths, capacity)
        on = np.zeros(len(uids), dtype=np.int64)
        chosen = handed_on(loads, capacity, kept) if left else []
        on[chosen] = loads[chosen]  # the load of a bin stands at its first item, where the bin is handed on
        return pd.DataFrame({"g": key[0], "uid": uids, "bin": uids[bins], "offset": places, "load": on})

    placed = durable(in_groups(dealt.select("g", "uid", "size"), ["g"], place, placed_schema), "placed")
    open_bins = placed.where("load > 0").select("g", "bin", "load")
    moves = None
    while left:
        left -= 1
        kept = fan_in * left
        merged_schema = "g int, bin long, into long, shift long, load long"

        def merge(key, part: pd.DataFrame, kept=kept) -> pd.DataFrame:
            part = part.sort_values("bin")
            uids = part["bin"].to_numpy()
            bins, places, loads = best_fit(part["load"].to_numpy(), capacity)
            on = np.zeros(len(uids), dtype=np.int64)
            chosen = handed_on(loads, capacity, kept)
            on[chosen] = loads[chosen]
            return pd.DataFrame({"g": key[0], "bin": uids, "into": uids[bins], "shift": places, "load": on})

        next_group = F.floor(F.col("g") / fan_in).cast("int").alias("g")
        merged = durable(in_groups(open_bins.select(next_group, "bin", "load"), ["g"], merge, merged_schema), "merged")
        open_bins = merged.where("load > 0").select("g", "bin", "load")
        step = merged.where("`into` != bin").select("bin", "into", "shift")
        if moves is None:
            moves = step
        else:  # what moved before moves on with the bin it is in
            onward = step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("shift").alias("more"))
            moves = moves.join(onward, "into", "left").select(
                "bin", F.coalesce("next", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift")
            ).unionAll(step)
    if moves is not None:
        # At most one move per group and round: a few rows for a quarter of a million pieces.
        moves = durable(moves, "moves")
        placed = placed.join(moves, "bin", "left").select(
            "uid", F.coalesce("into", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
    full = rows.where(F.col("size") >= capacity).select("row.*", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionAll(rows.where(F.col("size") < capacity).join(placed, "uid").select(
        "row.*", F.col("bin").alias("sequence_id"), "offset"))


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark, sf_dir):
    return pack(pieces(table(spark, sf_dir, "documents"), tokenizer_path()))
