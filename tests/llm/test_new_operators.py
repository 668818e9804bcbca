"""Spelling variants, Merkle manifest and packing against brute force, the library and their defined results for odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import merkle, packing, spelling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    text = " ".join(rng.choice(["stream", "streams", "strea", "xtream", "straem", "größer", "grösser"]) for _ in range(300))
    rows = [
        (1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, " \n\t ", "fr", "b", 3), (None, text + " Z字 <|endoftext|>", None, "b", 5), (5, "x" * 30_000, "en", None, 1),
        (6, " ".join("".join(rng.choice("abc") for _ in range(7)) for _ in range(9_000)), "en", "a", 1),
        (None, None, None, None, None), (7, "é" * 40, "fr", "b", 1), (8, "###", "fr", "é", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clash(df):
    names = ("row", "key", "node", "idx", "n", "word", "size", "uid", "bin", "length", "piece", "run", "top", "g", "load", "at")
    return df.withColumns({c: F.lit(1) for c in names})


# ------------------------------------------------------------------ spelling
def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    out = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= spelling.RATIO * n else None
        out[w] = (form, n, len(near[w]), counts[form] if form else None)
    result = {}
    for w, (form, *rest) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (form, root, *rest)
    return result


def plain_counts(rows, one_in, least=5):
    found = Counter()
    for key, text in rows:
        for run in spelling.letter_runs(text):
            run = run.decode("latin-1")
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= least}


def test_letter_runs_keep_other_case():
    assert [r.decode("latin-1") for r in spelling.letter_runs("Ab-CÉ×d字eF")] == ["ab", "cÉ×d", "ef"]


def test_index_equals_plain_comparison():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(300)})
    index = spelling.PositionIndex(words)
    for word in words + ["", "zzz", "abc" * 9]:
        same, longer, shorter = index.near(word)
        got = sorted(words[k] for bits in (same, longer, shorter) for k in spelling.members(bits))
        assert got == [v for v in words if one_apart(word, v)]


@pytest.mark.parametrize("tile_words", [spelling.TILE_WORDS, 3])
def test_near_words_in_tiles(spark, tile_words):
    rng = random.Random(2)
    counts = {"stem" + "".join(rng.choice("ab") for _ in range(rng.randint(2, 6))): rng.randint(5, 9) for _ in range(150)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(words, tile_words=tile_words).collect()}
    want = {}
    for w in counts:
        near = [v for v in counts if one_apart(w, v)]
        if near:
            best = min(near, key=lambda v: (-counts[v], v))
            want[w] = (len(near), counts[best], best)
    assert got == want


def test_variants_of_odd_rows(odd, nothing):
    for one_in in (None, 3):
        rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
        want = plain_variants(plain_counts(rows, one_in))
        got = spelling.variants(spelling.word_counts(clash(odd), one_in=one_in)).collect()
        assert {r["word"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert spelling.variants(spelling.word_counts(nothing)).count() == 0


# ------------------------------------------------------------------ merkle
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes, arity):
    """Top of a tree and the siblings of every node, per level as (before, after)."""
    steps = [[] for _ in nodes]
    places = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + arity] for k in range(0, len(nodes), arity)]
        for k, at in enumerate(places):
            run, slot = runs[at // arity], at % arity
            steps[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            places[k] = at // arity
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], steps


def plain_manifest(rows, arity):
    def leaf(r, text):
        values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    lower = {k: k + 32 for k in range(65, 91)}
    groups = defaultdict(list)
    for r in rows:
        whole = leaf(r, r["text"])
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["doc_id"] is not None
        shown = leaf(r, r["text"].translate(lower) if r["text"] is not None else None) if tampered else whole
        groups[r["source"]].append((r["doc_id"], whole, shown))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = plain_tree([x[1] for x in groups[s]], arity)
    root, over = plain_tree([trees[s][0] for s in order], arity)
    out = []
    for s, upper in zip(order, over):
        for (key, whole, shown), steps in zip(groups[s], trees[s][1]):
            steps = steps + upper
            node = shown
            for before, after in steps:
                node = sha(before + node + after)
            out.append((key, whole, trees[s][0], root, sha("".join(b + a for b, a in steps)), node, node == root))
    return Counter(out)


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_manifest_equals_plain_trees(spark, odd, arity):
    more = spark.range(60).select(
        "id", F.concat(F.lit("Text "), F.col("id").cast("string")), F.lit("en"), F.lit("a"), F.col("id")).toDF(*odd.columns)
    docs = clash(odd.unionAll(more))
    named = [F.col(c) for c in merkle.FIELDS]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = merkle.leaf_of(named)
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_of([*named[:-1], lower])).otherwise(leaf)
    got = merkle.manifest(docs, [F.col("doc_id")], F.col("source"), F.col("doc_id"), leaf, arity, shown).collect()
    want = plain_manifest(docs.collect(), arity)
    assert Counter(tuple(r) for r in got) == want
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)


def test_manifest_of_few_rows(odd, nothing):
    leaf = merkle.leaf_of([F.col(c) for c in merkle.FIELDS])
    args = ([F.col("doc_id")], F.col("source"), F.col("doc_id"), leaf)
    assert merkle.manifest(nothing, *args).count() == 0
    (one,) = merkle.manifest(odd.where("doc_id = 8"), *args).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof_sha256"] == sha("") and one["verified"]


# ------------------------------------------------------------------ packing
def test_piece_ids_equal_the_library():
    known = packing.piece_ids(packing.tokenizer_path())
    rng = random.Random(7)
    signs = "aAbZ'sdtlmvre09 \n\t\x0b\x1c\x85\x00\x7féÉßÿ÷×ªµ字ΣσİŐ́ <|>endoftext.,!#-"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    for text in [*texts, "a <|endoftext|> b<|endoftext|>'s", "it's'sa 'S 'RE", "x" * 20_000, "İstanbul ΣΑΣ"]:
        want = known.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(known.ids(text), dtype="<u4").tolist() == want
    assert known.ids(None) == known.ids("") == b""


def test_best_fit_by_hand():
    bins, places, loads = packing.best_fit(np.array([5, 4, 3, 6, 2]), 10)
    assert bins.tolist() == [0, 3, 0, 3, 0] and places.tolist() == [0, 6, 5, 0, 8] and loads[[0, 3]].tolist() == [10, 10]


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return held


@pytest.mark.parametrize("group", [packing.GROUP, 40])
def test_packed_pieces(odd, nothing, group):
    made = packing.pieces(clash(odd), packing.tokenizer_path()).cache()
    rows = packing.pack(made, group=group).collect()
    known = packing.piece_ids(packing.tokenizer_path())
    want = Counter()
    for r in odd.collect():
        ids = known.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], dtype="<u4")
            want[r["doc_id"], k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    held = check_sequences(rows, 2048)
    assert len(held) <= -(-sum(k[3] * n for k, n in want.items()) // 2048) + 2
    assert packing.pack(packing.pieces(nothing, packing.tokenizer_path())).count() == 0


def test_tree_of_groups_joins_open_bins(spark):
    """600 pieces over half a bin leave room that one small piece per group fills; the tree finds it."""
    sizes = [60] * 600 + [7] * 40 + [100] * 5 + [1]
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, length long")
    rows = packing.pack(items, capacity=100, group=20, fan_in=3).collect()
    held = check_sequences(rows, 100)
    assert len(rows) == len(sizes) and sorted(r["length"] for r in rows) == sorted(sizes)
    assert len(held) == 605
    again = packing.pack(items, capacity=100, group=20, fan_in=3).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
