"""Text operators against brute force, the library, round trips and their defined results for odd rows."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import (
    decontamination, html_text, language_id, language_model, mixing, quality_classifier, quality_rules,
    similarity_join, token_counts, warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(n, seed=0):
    rng = random.Random(seed)
    return [rng.choice("bdfglmnprst") + rng.choice("aeiou") + rng.choice("bdfglmnprst") for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a long text, one without blanks."""
    text = " ".join(words_of(80))
    rows = [
        (1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, " \n\t ", "fr", "b", 3), (None, text + " z", None, "b", 5), (5, "x" * 50_000, "en", None, 1),
        (6, " ".join(words_of(30_000, 3)), "en", "a", 1), (None, None, None, None, None), (7, "é" * 40, "fr", "b", 1),
        (8, "###", "fr", "b", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def clash(df):
    """The same rows with extra columns whose names operators use inside."""
    return df.withColumns({c: F.lit(1) for c in ("m", "row", "score", "key", "size", "id", "hits", "target", "uid")})


# ------------------------------------------------------------------ quality rules
def test_ledger_measures():
    text = "a b c a b c\nx # y\n\nx # y"
    got = dict(zip(quality_rules.MEASURES, quality_rules.measure(text)))
    assert got["n_words"] == 12 and got["n_symbols"] == 2 and got["n_dup_lines"] == 1
    # Windows "a b c" and "x # y" occur twice.
    assert got["n_repeat_words"] == 12
    assert got["word_chars"] == 12 and got["n_lines"] == 3


def test_longest_word_counts_code_points():
    """A word of many bytes does not hide one of more letters."""
    text = "字" * 1000 + " " + "x" * 2500 + " y"
    assert quality_rules.measure(text)[quality_rules.MEASURES.index("longest_word")] == 2500
    assert quality_rules.measure("é" * 7 + "\n\n")[quality_rules.MEASURES.index("longest_word")] == 7


def test_ledger_odd_rows(odd, nothing):
    rows = quality_rules.ledger(clash(odd)).collect()
    assert len(rows) == 11
    empty = [r for r in rows if r["n_words"] == 0]
    assert len(empty) == 4 and all(r["fail_bits"] & 1 for r in empty)
    kept = quality_rules.keep_documents(clash(odd))
    assert kept.columns == clash(odd).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 6]
    assert quality_rules.keep_documents(nothing).count() == 0


def test_policies_and_ablations(docs):
    ledger = quality_rules.ledger(docs).cache()
    rows = ledger.collect()
    for policy in quality_rules.POLICIES:
        mask = quality_rules.policy_mask(policy)
        got = {r["rule"]: r for r in quality_rules.ablations(ledger, policy).collect()}
        for rule in quality_rules.POLICIES[policy]:
            bit = 1 << quality_rules.RULE_NAMES.index(rule)
            assert got[rule]["failed"] == sum(bool(r["fail_bits"] & bit) for r in rows) if rule in got else True
            if rule in got:
                assert got[rule]["failed_alone"] == sum(r["fail_bits"] & mask == bit for r in rows)
                assert got[rule]["kept_without"] == sum(not r["fail_bits"] & mask & ~bit for r in rows)


# ------------------------------------------------------------------ language
def test_rank_distance_by_hand():
    predict = language_id._predictor(
        ["a", "b"],
        [(np.sort(language_id.top_keys(language_id.gram_keys("xy xy"))), np.arange(7)),
         (np.sort(language_id.top_keys(language_id.gram_keys("pq pq"))), np.arange(7))], 300)
    assert predict("xy")[0] == "a" and predict("pq")[0] == "b"
    assert predict("123 !?") == ("und", 0.0) and predict(None) == ("und", 0.0)


def test_gram_keys_count_padded_grams():
    got = Counter(language_id.gram_keys("Ab, a!").tolist())
    want = Counter()
    padded = "_ab_a_"
    codes = {"_": 32, "a": ord("a"), "b": ord("b")}
    for n in (1, 2, 3):
        for k in range(len(padded) - n + 1):
            gram = padded[k:k + n]
            if gram == "_" or n == 3 and gram[1] == "_":
                continue
            key = 0
            for c in gram:
                key = key << 21 | codes[c]
            want[key] += 1
    assert got == want


def test_language_accuracy_on_held_out_rows(docs):
    profiles = language_id.learn_profiles(language_id.training_rows(docs)).cache()
    assert profiles.groupBy("lang").count().agg(F.max("count")).first()[0] <= language_id.SIZE
    found = language_id.identify(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_blocks_agree(docs, monkeypatch):
    profiles = language_id.learn_profiles(docs).cache()
    one = language_id.identify(docs, profiles).orderBy("doc_id").collect()
    monkeypatch.setattr(language_id, "LANGUAGES_AT_ONCE", 2)
    assert language_id.identify(docs, profiles).orderBy("doc_id").collect() == one


def test_language_odd_rows(odd, nothing):
    profiles = language_id.learn_profiles(clash(odd))
    got = {r["doc_id"]: r for r in language_id.identify(clash(odd), profiles).collect()}
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == got[4]["lang_pred"] == got[8]["lang_pred"] == "und"
    assert got[7]["lang_pred"] == "fr"
    unknown = language_id.identify(odd, language_id.learn_profiles(nothing)).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"} and len(unknown) == 11


# ------------------------------------------------------------------ tokens
@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())


ODD_TEXTS = ["", " ", "  a", "<s> hi </s>", "▁a b", "日本語テキスト", "naïve ².x ³", "\x00a", "😀😀 hi", "x" * 300,
             "\n\n  foo\t\tbar", "12.8%", "f(b){c}; // $x$", "हिन्दी है", "\xa0a", "é" * 50, "▁▁x", "\r\n\r\n"]


def test_prefix_counts_equal_the_library(library, texts):
    count = token_counts.counter(token_counts.model_path())
    some = [*ODD_TEXTS, *texts.values()]
    assert [count.summary(t, 10**9)[0] for t in some] == [len(x) for x in library.encode(some)]
    rng = random.Random(5)
    for _ in range(60):
        text = rng.choice(some)
        at = rng.randrange(len(text) + 1)
        text = text[at:at + 40]
        prefixes = count.prefixes(text)
        assert prefixes.tolist() == [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert token_counts.unpack(token_counts.pack(prefixes)).tolist() == prefixes.tolist()
        limit = rng.randrange(1, 12)
        fits = token_counts.longest_within(prefixes, limit)
        assert prefixes[fits] <= limit and all(prefixes[fits + 1:] > limit)


def test_token_counts_odd_rows(odd, nothing, library):
    got = token_counts.token_counts(clash(odd), limit=100).collect()
    for r in got:
        if r["n_bytes"] == 0:
            assert r["n_tokens"] == r["fit_chars"] == 0
    want = {r["doc_id"]: len(library.encode(r["text"] or "")) for r in odd.collect() if r["doc_id"]}
    assert {r["doc_id"]: r["n_tokens"] for r in got if r["doc_id"]} == want
    assert token_counts.token_counts(nothing).count() == 0


def test_stored_prefixes_answer_without_encoding(docs, texts, library):
    tables = token_counts.prefix_tables(docs.limit(20)).withColumn("chars", (F.col("doc_id") % 50 + 3).cast("int"))
    for r in token_counts.tokens_at(tables, "doc_id", "chars").collect():
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]][:r["chars"]]))


# ------------------------------------------------------------------ pages
def test_article_of_a_page():
    page = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header><a href=x>Home</a>
    </header><nav><ul><li>menu</ul></nav><div id="cookie-notice">We use cookies</div><div class="sidebar"><p>Side</p></div>
    <div class="post-body"><h1>Title &amp; more</h1><p>First   para\nand <a href=q>link</a> &lt;x&gt; caf&eacute;.<p>Ti.</p>
    <script>var t = "</p>";</script><ul><li>one<li>two</ul><form><label>Name</label></form><p>A long last sentence.</p></div>
    <div class="comments"><p>I agree, and this is a very long comment indeed.</p></div><footer>c</footer>"""
    assert html_text.extract(page) == (
        "Title & more\n\nFirst para and link <x> café.\n\nTi.\n\none\n\ntwo\n\nA long last sentence.")


@pytest.mark.parametrize("page", [None, "", "<", "<!-- x -->", "<![x y", "<nav>only</nav>", "<script>", "</p></div>"])
def test_pages_without_an_article(page):
    assert html_text.extract(page) in ("", "<", "<![x y")


def test_smoothing_is_a_weighted_mean():
    ratios = np.array([0.0, 10.0, 0.0, 5.0])
    out = html_text.smooth(ratios)
    weight = [math.exp(-0.5 * d * d) for d in (0, 1, 2)]
    want = (ratios[0] * weight[0] + ratios[1] * weight[1] + ratios[2] * weight[2]) / sum(weight)
    assert out[0] == pytest.approx(want) and len(out) == 4


def test_cluster_threshold_is_the_best_cut():
    rng = random.Random(4)
    for _ in range(200):
        values = np.array([rng.choice([rng.random(), 5 + rng.random()]) for _ in range(rng.randint(2, 12))])
        x = sorted(values)
        cuts = [(np.var(x[:k]) * k + np.var(x[k:]) * (len(x) - k), k) for k in range(1, len(x))]
        k = min(cuts)[1]
        apart = np.mean(x[k:]) - np.mean(x[:k]) >= math.log(html_text.APART)
        assert html_text.cluster_threshold(values) == pytest.approx(x[k] if apart else x[0])


SENTENCE = "A sentence of the article that says one thing or another at some length. "
UNNAMED = f"""<html><body><div><a href=/>Home</a> <a href=/n>News</a></div><div><div><a href=/s>Shop</a></div><div><a href=/t>Terms</a></div></div>
<div><p>Title here</p><p>{SENTENCE * 4}</p><p>Short.</p><p>{SENTENCE * 3}</p><ul><li>first</li><li>second</li></ul><p>{SENTENCE * 5}</p></div>
<div><span>Some</span> <b>firm</b> <i>2024</i></div><div><a href=/x>Next story</a></div><div><a href=/y>Last story</a></div></body></html>"""
WANTED = ["Title here", (SENTENCE * 4).strip(), "Short.", (SENTENCE * 3).strip(), "first", "second", (SENTENCE * 5).strip()]


@pytest.mark.parametrize("around", ["{}", "<main>{}</main>"])
def test_unnamed_menus_and_footers_go(around, monkeypatch):
    """No name gives them away; without the clusters they stay."""
    page = around.format(UNNAMED)
    assert html_text.extract(page) == "\n\n".join(WANTED)
    monkeypatch.setattr(html_text, "content_lines", lambda lines: np.ones(len(lines), dtype=bool))
    assert "firm" in html_text.extract(page) and "Home" in html_text.extract(page)


def test_pages_of_every_kind_through_spark(spark):
    """Nulls, empty and very long pages, repeated rows, columns with clashing names, an empty table."""
    long = "<article>" + f"<p>{SENTENCE}</p>" * 5_000 + "</article>"
    rows = [(1, "u", UNNAMED), (1, "u", UNNAMED), (2, None, None), (None, "n", ""), (3, "l", long), (4, "m", "<p>only</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("text", "n_chars", "m", "row")})
    got = html_text.extract_pages(pages)
    found = Counter((r["page_id"], r["main"]["text"], r["main"]["n_chars"]) for r in got.collect())
    whole = "\n\n".join([SENTENCE.strip()] * 5_000)
    first = "\n\n".join(WANTED)
    assert found == Counter({(1, first, len(first)): 2, (2, "", 0): 1, (None, "", 0): 1, (3, whole, len(whole)): 1, (4, "only", 4): 1})
    assert {"text", "n_chars", "m", "row"} <= set(got.columns)
    assert html_text.extract_pages(pages.where("false")).count() == 0


def test_article_pages_whole(spark, sf):
    rows = html_text.extract_pages(spark.read.parquet(f"{sf}/pages.parquet")).select("url", "main.*").collect()
    assert all(len(r["text"]) == r["n_chars"] > 0 for r in rows)
    assert not any("track(" in r["text"] or "©" in r["text"] for r in rows)


# ------------------------------------------------------------------ archives
@pytest.fixture(scope="module")
def archived(spark):
    body = "<p>" + "twice " * 40
    rows = [(5, "u5", body), (3, "u3", body), (9, None, body), (1, "u\r\n1 %", None), (2, "u2", "short"), (4, "u4", "short"),
            (None, "n", body), (7, "big", "x" * 3_000_000), (3, "u3", body), (2**60 + 1, "far", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = warc.archive_folder(spark)
    return rows, warc.write_archives(pages, folder)


def test_archive_round_trip(archived):
    rows, manifest = archived
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows)
    seen = Counter((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"]) for r in got)
    assert seen == Counter((i, u, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, u, h in rows)
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), (2**60 + 1, "revisit", 3),
            (2, "response", None), (4, "response", None), (1, "response", None)} <= kinds
    payloads = {r["page_id"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    assert payloads[7] == b"x" * 3_000_000 and payloads[1] == b""


def test_archive_random_access_and_plain_decoding(archived):
    zstandard = pytest.importorskip("zstandard")
    rows, manifest = archived
    for m in manifest.collect():
        with warc.BundleReader(m["bundle"]) as bundle:
            record = bundle.record(m["frame"], m["start"], m["length"])
            assert record["page_id"] == m["page_id"] and record["record_id"] == m["record_id"]
            fs, path = warc.open_folder(m["bundle"])
            whole = fs.open_input_file(path).read()
            plain = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
            assert sum(1 for _ in warc.parse_records(plain)) == manifest.where(F.col("bundle") == m["bundle"]).count()


def test_archive_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark))).count() == 0


# ------------------------------------------------------------------ decontamination
def least_edits(text, item):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def test_edit_matches_equal_brute_force():
    items = [(k, " ".join(words_of(12, 100 + k))) for k in range(6)]
    matcher, rng = decontamination.Matcher(items), random.Random(2)
    for trial in range(120):
        number, item = rng.choice(items)
        chars = list(item)
        for _ in range(rng.randrange(9)):
            k = rng.randrange(len(chars))
            chars[k:k + rng.randrange(2)] = rng.choice([[], ["a"], ["t", " "]])
        text = " ".join(words_of(6, trial)) + " " + "".join(chars) + " " + " ".join(words_of(6, trial + 500))
        plain = decontamination.normal(text)
        got = {i: d for i, d, _, _ in matcher.search(text)}
        want = {i: least_edits(plain, t) for i, t in items}
        assert got == {i: d for i, d in want.items() if d <= decontamination.budget(len(dict(items)[i]))}


def test_short_items_and_scripts_without_blanks():
    """Short questions are found inside a document, at word boundaries; passages without blanks count by letters."""
    passage = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(60))
    items = [(1, "what is the capital of france"), (2, "art"), (3, passage), (4, passage[:8]), (5, "a cat sat down")]
    matcher = decontamination.Matcher([(k, decontamination.normal(t)) for k, t in items])

    def found(text):
        return {(i, d) for i, d, _, _ in matcher.search(text)}

    assert found("Quiz. What is the capital of France? Paris.") == {(1, 0)}
    assert found("Quiz. What is the capitol of France? Paris.") == {(1, 1)}
    assert found("xwhat is the capital of francex y") == {(1, 2)}  # two edits leave whole words: budget 2
    assert found("the party started") == set()
    assert found("The art of it") == found("ART") == found("art") == {(2, 0)}
    assert found("begin" + passage + "end") == {(3, 0), (4, 0)}
    assert found(passage[:30] + "x" + passage[31:]) == {(3, 1), (4, 0)}
    assert found(passage[20:]) == set()
    assert found("so a cat sat downstairs") == set() and found("so a cat sat dow, n") == {(5, 1)}
    assert [m for i, _, _, m in matcher.search("so a cat sat down, and a cat sat down") if i == 5] == ["a cat sat down"]


def test_short_matches_equal_brute_force():
    rng = random.Random(5)
    items = [(k, " ".join(words_of(n, 300 + k))) for k, n in enumerate((1, 2, 3, 4, 5, 6, 7))]
    matcher = decontamination.Matcher(items)
    for trial in range(150):
        chars = list(rng.choice(items)[1])
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(chars))
            chars[k:k + rng.randrange(2)] = rng.choice([[], ["a"], ["t", " "]])
        plain = decontamination.normal(" ".join(words_of(3, trial)) + " " + "".join(chars) + " " + " ".join(words_of(3, trial + 500)))
        at = [k for k in range(len(plain) + 1) if decontamination.between_words(plain, k)]
        want = {i: min(decontamination.edits(t, plain[a:b]) for a in at for b in at if a < b and b - a < 40) for i, t in items}
        assert {i: d for i, d, _, _ in matcher.search(plain)} == {
            i: d for i, d in want.items() if d <= decontamination.budget(len(dict(items)[i]))}


def test_decontamination_odd_rows(spark, odd, nothing):
    item = " ".join(words_of(80)[10:40]).upper()
    items = spark.createDataFrame(
        [(1, item), (1, item), (2, None), (3, ""), (4, "x y"), (None, "")], "item_id long, text string")
    rows = decontamination.contamination(clash(odd), items).collect()
    assert Counter((r["doc_id"], r["item_id"], r["distance"]) for r in rows) == Counter(
        {(1, 1, 0): 4, (None, 1, 0): 2})
    left = decontamination.drop_contaminated(clash(odd), items)
    assert left.count() == 8 and left.columns == clash(odd).columns
    assert decontamination.contamination(odd, items.where("item_id > 9")).count() == 0
    assert decontamination.contamination(nothing, items).count() == 0


def test_item_blocks_agree(spark, sf, docs, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    found = decontamination.contamination(docs, items).collect()
    clean = {r["doc_id"] for r in decontamination.drop_contaminated(docs, items).collect()}
    made = []

    class Seen(decontamination.Matcher):
        def __init__(self, block, error_rate):
            made.append(block)
            super().__init__(block, error_rate)

    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 2_000)
    monkeypatch.setattr(decontamination, "Matcher", Seen)
    many = decontamination.contamination(docs, items)
    assert Counter(map(tuple, many.collect())) == Counter(map(tuple, found))
    # every item is sent once, in blocks that stay small, and the result holds written tables instead of matchers
    assert len(made) > 3 and sum(map(len, made)) == items.count()
    assert max(sum(len(text) for _, text in block) for block in made) < 3 * decontamination.BLOCK_CHARS
    assert "ArrowEvalPython" not in many._jdf.queryExecution().optimizedPlan().toString()
    left = decontamination.drop_contaminated(docs, items)
    assert {r["doc_id"] for r in left.collect()} == clean and left.columns == docs.columns
    assert left._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


# ------------------------------------------------------------------ classifier
def test_context_vectors_by_hand():
    places, signs = quality_classifier.index_vectors()
    slots = np.array([5, 9, 5, 700])
    total = np.zeros((quality_classifier.SLOTS + 1) * quality_classifier.DIM)
    quality_classifier.add_contexts(total, slots, places, signs)
    want = np.zeros((quality_classifier.SLOTS + 1, quality_classifier.DIM))
    for i, word in enumerate(slots):
        for j, other in enumerate(slots):
            if 0 < abs(i - j) <= quality_classifier.WINDOW:
                want[word, places[other]] += signs[other]
    assert np.allclose(total.reshape(want.shape), want)


def test_long_texts_are_counted_whole(monkeypatch):
    import pandas as pd

    text = " ".join(words_of(900, 4))
    whole = next(quality_classifier._context_tables(iter([pd.DataFrame({"text": [text]})])))
    monkeypatch.setattr(quality_classifier, "CHUNK", 100)
    parts = next(quality_classifier._context_tables(iter([pd.DataFrame({"text": [text]})])))
    assert whole.equals(parts)


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < quality_classifier.sigmoid(z)).astype(float)
    assert quality_classifier.fit_temperature(z * 3, y) == pytest.approx(3, rel=0.1)


def test_classifier_held_out(spark, docs, sf, odd, nothing):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    vectors = quality_classifier.word_vectors(docs)
    net = quality_classifier.fit(docs, labels.where(fold != 2), vectors)
    column = quality_classifier.score_column(vectors, net)
    rows = docs.where(fold == 2).select("doc_id", column(F.col("text")).alias("p")).join(labels, "doc_id").collect()
    good = [r["p"] for r in rows if r["quality"] == 1]
    bad = [r["p"] for r in rows if r["quality"] == 0]
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.85 and all(0 <= p <= 1 for p in good + bad)
    scores = odd.select(column(F.col("text")).alias("p")).collect()
    assert len(scores) == 11 and all(0 <= r["p"] <= 1 for r in scores)
    none = quality_classifier.fit(docs, labels.where("false"), vectors)
    assert none is None
    assert odd.select(quality_classifier.score_column(vectors, none)(F.col("text")).alias("p")).distinct().count() == 1
    assert not quality_classifier.word_vectors(nothing).any()


# ------------------------------------------------------------------ language model
def test_scores_equal_brute_force(docs, texts, odd, nothing):
    model = language_model.fit(docs)
    counts, total, distinct, grams = model
    c = Counter(w for t in texts.values() for w in language_model.tokens(t))
    assert (total, distinct) == (sum(c.values()), len(c))
    space = total + distinct + 1
    d = language_model.DISCOUNT

    def p(history, token):
        """Backoff probability by the definition, without an automaton."""
        history = history[-(len(grams) - 1):]
        while history and " ".join(history) not in grams[len(history) - 1]:
            history = history[1:]
        if not history:
            return (c[token] + 1) / space
        n = len(history)
        whole = grams[n - 1][" ".join(history)]
        follow = followers[n].get(" ".join(history), {})
        if token in follow:
            return (follow[token] - d) / whole
        if (n, tuple(history)) not in weights:
            left = 1 - sum((x - d) / whole for x in follow.values())
            weights[n, tuple(history)] = left / (1 - sum(p(history[1:], w) for w in follow))
        return weights[n, tuple(history)] * p(history[1:], token)

    followers, weights = {n: {} for n in range(1, len(grams))}, {}
    for n in range(1, len(grams)):
        for gram, count in grams[n].items():
            head, token = gram.rsplit(" ", 1)
            followers[n].setdefault(head, {})[token] = count
    got = {r["doc_id"]: r for r in language_model.score(clash(docs), model).collect()}
    for doc_id in sorted(texts)[:40]:
        words = language_model.tokens(texts[doc_id])
        base = sum(math.log10((c[w] + 1) / space) for w in words)
        full = sum(math.log10(p(words[:k], w)) for k, w in enumerate(words))
        r = got[doc_id]
        assert r["n_tokens"] == len(words) and r["n_known"] == len(words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(full, rel=1e-7)
    # What follows a history adds up to at most one: tokens never seen share what is left.
    history = max(followers[1], key=lambda h: len(followers[1][h]))
    assert sum(p([history], w) for w in c) + p([history], "never seen") == pytest.approx(1, abs=1e-6)
    rows = language_model.score(odd, model).collect()
    assert len(rows) == 11
    assert sum(r["n_tokens"] == 1 for r in rows) == 4
    fresh = language_model.score(odd, language_model.fit(nothing)).collect()
    assert all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == 0 for r in fresh)


def test_scores_do_not_depend_on_the_core(docs):
    """The share bounds what tasks are sent, not which n-grams count."""
    whole, small = language_model.fit(docs), language_model.fit(docs, share=1e-3)
    assert small[3][0].core > whole[3][0].core == language_model.LEAST
    assert all(dict(a) == dict(b) for a, b in zip(whole[3], small[3]))
    a, b = ({r["doc_id"]: r for r in language_model.score(docs, m).collect()} for m in (whole, small))
    assert a.keys() == b.keys()
    for key, r in a.items():
        assert b[key]["n_known"] == r["n_known"]
        assert b[key]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)
        assert b[key]["score"] == pytest.approx(r["score"], rel=1e-9)


def test_rare_grams_are_not_sent(spark):
    """Slots that tasks count hold every n-gram seen often enough and keep the others out of the counts that are sent."""
    often = [f"a{k} b{k} c{k}" for k in range(50)]
    texts = [*often, *often, *often, *[f"a{k} c{k} b{k} a{k}" for k in range(50)], *often[:7], None, "", "a1"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    every = np.full(language_model.SLOTS, ~np.uint64(0))
    for order in (2, 3):
        want = Counter()
        for words in map(language_model.tokens, texts):
            want.update([" ".join(words[k:k + order]) for k in range(len(words) - order + 1)])
        assert min(want.values()) < language_model.LEAST
        slots = language_model.frequent_slots(docs, order, every)
        got = {r["gram"]: r["n"] for r in language_model.gram_counts(docs, order, every, slots).collect()}
        assert got == {gram: n for gram, n in want.items() if n >= language_model.LEAST}


def test_slots_add_up():
    """Planes count to LEAST, however the hashes are dealt."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    seen = np.concatenate([hashes, hashes[:200], hashes[:100], hashes[:50]])
    whole, sums = np.zeros((2, language_model.LEAST, language_model.SLOTS), dtype=np.uint64)
    language_model._add_hashes(whole, seen)
    for part in np.array_split(rng.permutation(seen), 4):
        one = np.zeros_like(sums)
        language_model._add_hashes(one, part)
        sums = language_model._summed(sums, one)
    assert np.array_equal(whole, sums)
    assert [int(language_model.in_bits(plane, hashes).sum()) for plane in whole] == [300, 200, 100]


def test_core_is_filled(docs):
    """The core takes as many n-grams as its bound allows, by one count for all orders."""
    _, _, _, grams = language_model.fit(docs, share=1e-3)
    core = grams[0].core

    def reach(n):
        return max(found.table.where(f"n >= {n}").count() for found in grams)

    assert core > language_model.LEAST and reach(core) <= 1000 < reach(core - 1)


# ------------------------------------------------------------------ mixing
def water(sizes, order):
    """Targets by definition: clamp and share again until nothing is above its limit."""
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 3 * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix_reaches_targets(docs):
    rows = mixing.mix(clash(docs)).select("row.doc_id", "size", "source_size", "target", "taken").join(
        docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = water(sizes, sorted(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    again = mixing.mix(docs.repartition(5)).select("row.doc_id", "size", "source_size", "target", "taken").collect()
    assert Counter((r["doc_id"], r["taken"]) for r in again) == Counter((r["doc_id"], r["taken"]) for r in rows)


def test_mix_clamps_small_sources_and_hot_documents(spark, nothing, odd, monkeypatch):
    monkeypatch.setattr(mixing, "FEW", 3)
    rows = [(k, "w " * 10, None, "a", 0) for k in range(2)] + [(7, "v " * 3, None, "c", 0)] * 400
    rows += [(1000 + k, "u " * (k % 9), None, "b", 0) for k in range(300)] + [(None, None, None, None, None)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, ("doc_id", "source")).select("row.*", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = water({s: sizes[s] for s in sizes}, ["a", "b", "c", None])
    assert want["a"] == 60
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(odd).count() == 11


def test_mix_of_rows_that_share_an_id_is_the_same_on_every_run(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW", 3)
    rows = [(7, f"w{k} " * 3, None, "a", 0) for k in range(60)] + [(k, "v " * 50, None, "b", 0) for k in range(9)]
    first = spark.createDataFrame(rows, SCHEMA).repartition(3)
    second = spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1)
    got = [Counter(map(tuple, mixing.mix(df, ("doc_id", "text")).select("row.*", "taken").collect())) for df in (first, second)]
    assert got[0] == got[1] and len(got[0]) == 69
    assert len({taken for _, _, taken in got[0]}) > 1


def test_profiles_stop_early_in_each_task(spark):
    plan = language_id.learn_profiles(spark.createDataFrame([(1, "abc", "x", "a", 0)], SCHEMA))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


# ------------------------------------------------------------------ similarity join
def exact_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = t.encode().split() if t else []
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root, links = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, links


def near_copies(n, seed=1):
    base, rng = words_of(200, 77), random.Random(seed)
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = "changed" + str(rng.randrange(50))
        out.append(" ".join(words))
    return out


def check_join(spark, texts):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], SCHEMA).repartition(4)
    roots, links = exact_classes(texts)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in similarity_join.similar(clash(df)).collect()}
    assert got == {i: (roots[i], links[i]) for i in texts}


def test_join_equals_brute_force(spark, texts):
    check_join(spark, texts)


def test_join_of_crowded_group_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "TILE", 16)
    some = near_copies(90)
    texts = {k: t for k, t in enumerate([*some, *some[:7], "", None, "one two", "one two", "ONE two"])}
    check_join(spark, texts)


def test_tiles_get_their_own_candidates_only(spark, monkeypatch):
    """Every candidate pair of a crowded group is sent to one pair of tiles, once."""
    monkeypatch.setattr(similarity_join, "TILE", 16)
    keys = [hashlib.md5(str(k).encode()).digest() for k in range(100)]
    found = spark.createDataFrame(
        [(k, keys[0], b"".join(keys[n + 1:])) for n, k in enumerate(keys[:-1])], similarity_join.CANDIDATE)
    grouped = spark.createDataFrame([(k, keys[0], 100) for k in keys], "key binary, comp binary, size long")
    tile = {bytes(r["key"]): r["t"] for r in similarity_join.tiled(grouped, "comp", "size").collect()}
    pairs = []
    for r in similarity_join.listed(found, grouped).collect():
        others = b"".join(map(bytes, r["others"]))
        for k in range(0, len(others), 16):
            pairs.append((bytes(r["key"]), others[k:k + 16]))
            assert sorted(tile[key] for key in pairs[-1]) == [r["i"], r["j"]]
    assert len(pairs) == len(set(pairs)) == 4950


def test_posterior_is_a_binomial_tail():
    assert similarity_join.reach_probability(32, 32, 0.8) == pytest.approx(1 - 0.8**33)
    assert similarity_join.reach_probability(0, 1, 0.5) == pytest.approx(0.25)
    least = similarity_join._least
    assert all(similarity_join.reach_probability(least[n] - 1, n, 0.8) < similarity_join.TOLERANCE for n in least)


def test_join_odd_rows(odd, nothing):
    rows = similarity_join.similar(odd).collect()
    assert len(rows) == 11
    assert [r["n_links"] for r in rows if r["doc_id"] == 1] == [2, 2]  # each other, and the row without an id
    kept = similarity_join.keep_one_of_each(clash(odd))
    assert kept.columns == clash(odd).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert similarity_join.similar(nothing).count() == similarity_join.keep_one_of_each(nothing).count() == 0
