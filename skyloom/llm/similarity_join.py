"""Jaccard self-join over word shingles with Bayesian candidate pruning.

Documents with the same set of shingles are one class of copies and are compared once. Classes that share a band of
MinHash values meet in a bucket; there, their values are compared ``ROUND`` at a time, and a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold is below ``TOLERANCE`` (uniform prior: after m of n
matches it is a binomial tail). The rest are verified exactly on their shingles. With 32 bands of 5 values, a pair at
the threshold of 0.8 meets in no bucket with probability 3e-6, and less above it.

Pairs are never sent as rows. A crowded bucket is cut into tiles of at most ``TILE`` members; a task compares two tiles
and sends one row per member, with the list of those it may be linked to and a spanning edge. Candidates that hang
together are verified in one group (or in tiles of one, each of which is sent the candidates it compares and no others),
which sends counts of links and spanning edges, again one row per member. Each pair counts in the first band it shares only.

Defined results: words are as in WORD, case counts; a text of fewer than five words is one shingle; a null text or one
without words has no shingles, is linked to nothing, and is its own class; repeated rows are copies of each other;
``class_id`` is the least id of a class, null only if all its ids are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import batches_of, byte_words, each, fields, query, table
from skyloom.llm.components import components
from skyloom.session import durable

SHINGLE = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction of whole numbers
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
ROUND = 32
TOLERANCE = 1e-6
TILE = 512
SEED = 11
KEPT_WORDS = 200_000
BATCH_ROWS = 1_000  # texts, signatures or sets that a worker holds at once besides its group
MIX = np.uint64(0x9E3779B97F4A7C15)
SIGNATURE = fields(key=T.BinaryType(), sig=T.BinaryType())
SHINGLED = fields(key=T.BinaryType(), data=T.BinaryType())


# ---------------------------------------------------------------- shingles and signatures
class _Hashes(dict):
    """Word -> 64-bit hash, kept per worker up to a bound."""

    def __missing__(self, word):
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, SEED)
        return value


_hashes = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    words = byte_words(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = (out ^ h[k:len(h) - n + 1 + k]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, HASHES, dtype=np.uint32))


_a, _b = _multipliers()


def signature(found: np.ndarray) -> np.ndarray:
    """The last 16 bits of every MinHash value of a set of shingles."""
    low = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    x = (found >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(x), 4096):
        part = x[None, start:start + 4096] * _a[:, None] + _b[:, None]
        part ^= part >> np.uint32(15)
        np.minimum(low, (part * np.uint32(0x2C1B3C6D)).min(axis=1), out=low)
    return low.astype(np.uint16)


def key_of(found: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


def _signed(text):
    found = shingles(text)
    return (key_of(found), signature(found).tobytes()) if len(found) else (None, None)


def _shingled(text):
    found = shingles(text)
    return key_of(found), found.tobytes()


# ---------------------------------------------------------------- Bayesian pruning
def reach_probability(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold) after ``matches`` of ``compared`` values agree, from a uniform prior."""
    n = compared + 1
    return math.fsum(math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in range(matches + 1))


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After each round: the fewest matches a pair may have."""
    return {
        n: next(m for m in range(n + 1) if reach_probability(m, n, threshold) >= tolerance)
        for n in range(ROUND, HASHES + 1, ROUND)
    }


_least = least_matches(THRESHOLD[0] / THRESHOLD[1])


def surviving_pairs(left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose signatures survive all rounds; ``right`` None: pairs within ``left``, each once."""
    other = left if right is None else right
    rows, columns = [], []
    for start in range(0, len(left), 256):
        same = np.zeros((len(left[start:start + 256]), len(other)), dtype=np.int16)
        for k in range(ROUND):
            same += left[start:start + 256, k, None] == other[None, :, k]
        a, b = np.nonzero(same >= _least[ROUND])
        rows.append(a + start)
        columns.append(b)
    a, b = np.concatenate(rows), np.concatenate(columns)
    if right is None:
        a, b = a[a < b], b[a < b]
    out_a, out_b = [], []
    for start in range(0, len(a), 100_000):
        pa, pb = a[start:start + 100_000], b[start:start + 100_000]
        matches = (left[pa, :ROUND] == other[pb, :ROUND]).sum(axis=1)
        for n in range(2 * ROUND, HASHES + 1, ROUND):
            matches = matches + (left[pa, n - ROUND:n] == other[pb, n - ROUND:n]).sum(axis=1)
            stay = matches >= _least[n]
            pa, pb, matches = pa[stay], pb[stay], matches[stay]
        out_a.append(pa)
        out_b.append(pb)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (a, b)


def first_shared_band(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    same = (left.reshape(-1, BANDS, ROWS) == right.reshape(-1, BANDS, ROWS)).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), -1)


def local_roots(n: int, a, b) -> list[int]:
    """Root of each of ``n`` members under the links a-b."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


# ---------------------------------------------------------------- tiles
def tiled(df: DataFrame, group: str, size: str) -> DataFrame:
    """Rows with columns ``t, i, j``: the tile of a member, and every pair of tiles its rows take part in."""
    n = F.ceil(F.col(size) / TILE).cast("int")
    own = df.withColumn("t", F.pmod(F.xxhash64("key"), n).cast("int"))
    pair = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda x: F.struct(F.least(x, F.col("t")).alias("i"), F.greatest(x, F.col("t")).alias("j")),
    )
    return own.withColumn("p", F.explode(pair)).withColumns({"i": F.col("p.i"), "j": F.col("p.j")}).drop("p", size)


def in_groups(df: DataFrame, by: list[str], function, schema) -> DataFrame:
    """``function(group values, frame)`` -> frame for every group; many small groups share a task and a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            keys = [batch[c].to_numpy() for c in by]
            change = np.ones(len(batch), dtype=bool)
            change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            cuts = [*np.flatnonzero(change), len(batch)]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                now = tuple(k[a] for k in keys)
                if last is not None and now != last:
                    out.append(function(last, pd.concat(held) if len(held) > 1 else held[0]))
                    held = []
                last = now
                held.append(batch.iloc[a:b])
            out = [x for x in out if x is not None]
            if out:
                yield pd.concat(out)
        if held:
            out = function(last, pd.concat(held) if len(held) > 1 else held[0])
            if out is not None:
                yield out

    return df.repartition(*by).sortWithinPartitions(*by).mapInPandas(run, schema)


CANDIDATE = "key binary, root binary, others binary"


def _compare_tiles(group, rows: pd.DataFrame) -> pd.DataFrame | None:
    bucket, i, j = group
    if len(rows) < 2:
        return None
    keys, tiles = rows["key"].to_numpy(), rows["t"].to_numpy()
    sigs = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint16).reshape(len(rows), HASHES)
    if i == j:
        a, b = surviving_pairs(sigs, None)
    else:
        left, right = np.flatnonzero(tiles == i), np.flatnonzero(tiles == j)
        if not len(left) or not len(right):
            return None
        a, b = surviving_pairs(sigs[left], sigs[right])
        a, b = left[a], right[b]
    if not len(a):
        return None
    first = np.concatenate([
        first_shared_band(sigs[a[s:s + 50_000]], sigs[b[s:s + 50_000]]) for s in range(0, len(a), 50_000)
    ]) == bucket & (BANDS - 1)
    a, b = a[first], b[first]
    if not len(a):
        return None
    root = local_roots(len(rows), a.tolist(), b.tolist())
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    owners, starts = np.unique(a, return_index=True)
    lists = {o: b"".join(keys[part]) for o, part in zip(owners.tolist(), np.split(b, starts[1:]))}
    named = sorted(set(a.tolist()) | set(b.tolist()))
    return pd.DataFrame({
        "key": [keys[k] for k in named], "root": [keys[root[k]] for k in named], "others": [lists.get(k) for k in named],
    })


LISTED = "key binary, comp binary, i int, j int, t int, others binary"


def _by_tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each list cut by the tile of the partners; a part goes to the one pair of tiles that compares them."""
    for batch in batches:
        out = []
        for key, others, comp, n, t in batch[["key", "others", "comp", "n", "t"]].itertuples(index=False):
            parts: dict[int, list[bytes]] = {}
            if n == 1:
                parts[0] = [others]
            else:
                for k in range(0, len(others), 16):
                    other = others[k:k + 16]
                    # As in ``tiled``: Spark's xxhash64 is XXH64 with seed 42, as a signed number.
                    value = xxhash.xxh64_intdigest(other, 42)
                    parts.setdefault((value - (value >> 63 << 64)) % n, []).append(other)
            out += [(key, comp, min(t, p), max(t, p), t, b"".join(part)) for p, part in parts.items()]
        yield pd.DataFrame(out, columns=["key", "comp", "i", "j", "t", "others"])


def listed(found: DataFrame, grouped: DataFrame) -> DataFrame:
    """``key, comp, i, j, t, others``: the candidates of a member for each pair of tiles, each pair of members once.

    Such a list names members of one tile only.
    """
    n = F.ceil(F.col("size") / TILE).cast("int")
    lists = found.where("others IS NOT NULL").select("key", "others").join(grouped, "key").select(
        "key", "others", "comp", n.alias("n"), F.pmod(F.xxhash64("key"), n).cast("int").alias("t"))
    return lists.mapInPandas(_by_tile, LISTED).groupBy("key", "comp", "i", "j", "t").agg(
        F.collect_list("others").alias("others"))


VERIFIED = "key binary, root binary, links long"


def _verify(group, rows: pd.DataFrame) -> pd.DataFrame | None:
    sets = rows[rows["data"].notna()].drop_duplicates("key")
    lists = rows[rows["others"].notna()]
    if len(sets) < 2 or not len(lists):
        return None
    keys, copies = sets["key"].tolist(), sets["n"].to_numpy()
    at = {key: k for k, key in enumerate(keys)}
    arrays = [np.frombuffer(d, dtype=np.uint64) for d in sets["data"]]
    sizes = np.array([len(x) for x in arrays])
    found, columns = np.unique(np.concatenate(arrays), return_inverse=True)
    parts = np.split(columns, np.cumsum(sizes)[:-1])
    mark = np.zeros(len(found), dtype=bool)
    links = np.zeros(len(keys), dtype=np.int64)
    pairs_a, pairs_b = [], []
    wanted: dict[int, list[int]] = {}
    for key, others in zip(lists["key"], lists["others"]):
        a = at.get(key)
        if a is not None:
            others = b"".join(others)
            others_ = (at.get(others[k:k + 16]) for k in range(0, len(others), 16))
            wanted.setdefault(a, []).extend(b for b in others_ if b is not None)
    for a, others in wanted.items():
        mark[parts[a]] = True
        for start in range(0, len(others), 256):
            b = np.array(others[start:start + 256])
            cut = np.concatenate(([0], np.cumsum(sizes[b])[:-1]))
            both = np.add.reduceat(mark[np.concatenate([parts[k] for k in b])].astype(np.int64), cut)
            linked = b[THRESHOLD[1] * both >= THRESHOLD[0] * (sizes[a] + sizes[b] - both)]
            np.add.at(links, linked, copies[a])
            links[a] += copies[linked].sum()
            pairs_a += [a] * len(linked)
            pairs_b += linked.tolist()
        mark[parts[a]] = False
    if not pairs_a:
        return None
    root = local_roots(len(keys), pairs_a, pairs_b)
    named = np.flatnonzero(links).tolist()
    return pd.DataFrame({"key": [keys[k] for k in named], "root": [keys[root[k]] for k in named], "links": links[named]})


# ---------------------------------------------------------------- join
def _bucket(band: int):
    """Bucket of a band: a hash of its values, with the number of the band in the last five bits."""
    value = F.substring("sig", 2 * ROWS * band + 1, 2 * ROWS)
    high = F.xxhash64(F.lit(band), value).bitwiseAND(F.lit(~(BANDS - 1)).cast("long"))
    return high.bitwiseOR(F.lit(band).cast("long"))


def candidates(sets: DataFrame) -> DataFrame:
    """Candidate links among ``sets(key, sig)``: one row per member and bucket, ``key, root, others``."""
    buckets = sets.select("key", F.explode(F.array(*[_bucket(b) for b in range(BANDS)])).alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = durable(buckets.join(crowded, "bucket"), "members")
    tiles = tiled(members.join(sets.select("key", "sig"), "key"), "bucket", "size")
    return in_groups(tiles.select("bucket", "i", "j", "t", "key", "sig"), ["bucket", "i", "j"], _compare_tiles, CANDIDATE)


def verified(docs: DataFrame, sets: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, root, links``: exact links of candidates, counted per group of tiles."""
    roots = components(found, "key", "root")
    grouped = durable(
        roots.join(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root").withColumnRenamed("node", "key")
        .withColumnRenamed("root", "comp"), "comps",
    )
    wanted = durable(sets.select("key", "rep", "n").join(grouped, "key"), "wanted")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        wanted.select("rep").distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi")
    data = texts.select(each(_shingled, SHINGLED)(F.col("text")).alias("s")).select("s.*")
    none = F.lit(None)
    own = wanted.join(data, "key").select("key", "comp", "size", "n", "data", none.cast("array<binary>").alias("others"))
    lists = listed(found, grouped).select(
        "comp", "i", "j", "t", "key", F.lit(0).cast("long").alias("n"), none.cast("binary").alias("data"), "others")
    tiles = tiled(own, "comp", "size").select("comp", "i", "j", "t", "key", "n", "data", "others").unionAll(lists)
    return in_groups(tiles, ["comp", "i", "j"], _verify, VERIFIED)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_md5, key, class_key, class_id, n_links`` per row of ``docs``.

    ``n_links`` is the number of other rows at or above the threshold; ``class_key`` is null for texts without shingles.
    """
    with batches_of(docs.sparkSession, BATCH_ROWS):
        rows = durable(
            docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("text_md5"),
                        each(_signed, SIGNATURE)(F.col(text_col)).alias("s")).select("id", "text_md5", "s.*"), "signed",
        )
        sets = durable(
            rows.where("key IS NOT NULL").groupBy("key").agg(
                F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig")), "sets",
        )
        found = durable(candidates(sets), "candidates")
        linked = durable(verified(docs, sets, found, id_col, text_col), "verified")
    roots = components(linked, "key", "root")
    named = roots.join(sets.select(F.col("key").alias("node"), "rep"), "node")
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    links = linked.groupBy("key").agg(F.sum("links").alias("links"))
    classes = named.join(least, "root").select(F.col("node").alias("key"), F.col("root").alias("class_key"), "class_id")
    info = durable(
        sets.select("key", "rep", "n").join(classes, "key", "left").join(links, "key", "left").select(
            "key", F.coalesce("class_key", "key").alias("class_key"),
            F.when(F.col("class_key").isNull(), F.col("rep")).otherwise(F.col("class_id")).alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ), "classes",
    )
    return rows.drop("sig").join(info, "key", "left").select(
        F.col("id").alias(id_col), "text_md5", "key", "class_key",
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class of similar rows: the one with the least id; rows without shingles all stay."""
    names = docs.columns
    found = similar(docs, id_col, text_col)
    first = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_md5")
    kept = durable(
        found.where("key IS NOT NULL").groupBy("class_key").agg(F.min(first).alias("first"))
        .select(F.col("first.id").alias("_id"), F.col("first.text_md5").alias("_md5")).distinct(), "kept",
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    blank = F.coalesce(F.length(F.regexp_replace(F.col(f"row.`{text_col}`"), r"[\x20\x09-\x0D]+", "")), F.lit(0)) == 0
    texts = row.where(~blank).withColumns({
        "id": F.col(f"row.`{id_col}`"), "md5": F.unhex(F.md5(F.col(f"row.`{text_col}`").cast("binary")))})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("md5") == F.col("_md5"))
    chosen = texts.join(kept, same, "left_semi")
    # Rows that repeat id and text are one row of the class; only such rows, if any, are compared.
    often = durable(
        found.where("key IS NOT NULL").groupBy(F.col(id_col).alias("_id"), F.col("text_md5").alias("_md5"))
        .agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("_id", "_md5"), "repeated",
    )
    once = chosen.join(often, same, "left_anti").select("row")
    many = chosen.join(often, same, "left_semi").dropDuplicates(["id", "md5"]).select("row")
    return once.unionAll(many).unionAll(row.where(blank)).select("row.*")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * k >= 4 * (x.n + y.n - k)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS class_id FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM c LEFT JOIN k USING (doc_id)
"""


@query("op7_jaccard_join", ORACLE)
def op7_jaccard_join(spark, sf_dir):
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
