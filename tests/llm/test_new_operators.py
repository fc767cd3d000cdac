"""Spelling variants, collocations and decontamination against brute force and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, decontamination, spelling_variants, word_stream

DIR = "/root/testdata/sf0.001"
SMALL = {c: c + 32 for c in range(65, 91)}
ODD = [
    (1, None, "en"), (2, "", None), (3, " \t\n.", "en"), (4, "a", "en"), (5, "same words here again", "en"), (5, "same words here again", "en"), (None, "Spelling spelling, no id", None),
    (None, None, None), (7, "x" * 5000 + " " + "ÀÉ× colour÷colours COLOUR naïveté", "fr"), (8, "spelling " * 4000, "de"), (9, "🎉🎉 \x85y\x1cz\x00 spelings speling ＡＢＣ", "xx")]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with further columns whose names clash with inner ones."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    clash = ["row", "word", "n", "print", "key", "words", "phrase", "spans", "items", "n_words", "a.b", "name", "none"]
    return df.withColumns({c: F.lit("clash") for c in clash}).repartition(3).cache()


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---- spelling variants ------------------------------------------------------------


def word_table(texts, least, min_count):
    """Words and their counts as the contract puts them, letter by letter."""
    n = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(words, ratio):
    near = {w: [] for w in words}
    by_part = defaultdict(list)
    for w in words:
        for part in {(0, w[:2]), (1, w[-2:])}:
            by_part[part].append(w)
    for group in by_part.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                if abs(len(a) - len(b)) < 2 and b not in near[a] and one_apart(a, b):
                    near[a].append(b)
                    near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def random_words(seed, n, least):
    rng = random.Random(seed)
    parts = ["er", "on", "th", "an", "a", "b", "ç", "é", "aa", "xyz"]
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(parts) for _ in range(rng.randrange(3, 9)))
        at, letter = rng.randrange(len(w)), rng.choice("abeé")
        words |= {x for x in (w, w[:at] + rng.choice(["", letter, w[at] + letter]) + w[at + 1:]) if len(x) >= least}
    return sorted(words)


@pytest.mark.parametrize("least", [4, 7])
def test_near_words_equal_brute_force(spark, least):
    words = random_words(least, 700, least)
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if one_apart(a, b)}
    assert set(rows_of(spelling_variants.near_pairs(df))) == want and len(want) > 200


def test_pivots_are_apart_and_rarest():
    rng = random.Random(3)
    for word in random_words(5, 300, 4):
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        rng.shuffle(grams)
        ranks = {g: k for k, g in enumerate(grams)}
        prefix = spelling_variants.prefix_of(word, ranks)
        a, b = spelling_variants.pivots_of(word, prefix, ranks)
        cost = lambda x, y: ranks[word[x:x + 2]] + ranks[word[y:y + 2]]
        assert b - a >= 2 and cost(a, b) == min(cost(x, y) for x in prefix for y in prefix if y - x >= 2)


def test_variants_of_documents_equal_brute_force(spark, docs, corpus):
    every = docs.select("doc_id", "text").unionByName(corpus.select("doc_id", "text"))
    texts = [(r["doc_id"], r["text"]) for r in every.collect()]
    got = rows_of(spelling_variants.spelling_variants(every))
    assert len(got) == len(set(got)) and set(got) == variants(word_table(texts, 7, 2), 10)
    small = [(d, t) for d, t, _ in ODD]
    assert set(rows_of(spelling_variants.spelling_variants(docs, least=4, min_count=1, ratio=2))) == variants(word_table(small, 4, 1), 2)
    assert rows_of(spelling_variants.spelling_variants(docs.where("false"))) == []
    with pytest.raises(ValueError):
        spelling_variants.spelling_variants(docs, least=3)


def test_forms_are_followed_to_the_last(spark):
    # a chain: each is one letter from the next and ten times as frequent
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx"]
    df = spark.createDataFrame([(k, (w + " ") * 2 * 10 ** i) for k, (i, w) in enumerate(enumerate(chain))], "doc_id long, text string")
    if word_table([(r["doc_id"], r["text"]) for r in df.collect()], 7, 2).keys() != set(chain):
        pytest.skip("the noise takes a letter of the chain")
    found = {r["word"]: (r["form"], r["root"]) for r in spelling_variants.spelling_variants(df).collect()}
    assert found == {chain[0]: (chain[1], chain[3]), chain[1]: (chain[2], chain[3]), chain[2]: (chain[3], chain[3]), chain[3]: (None, chain[3])}


# ---- collocations -----------------------------------------------------------------


def best_phrases(texts, max_words, min_count, top, percent):
    f, n = Counter(), Counter()
    for lang, text in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(SMALL)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i:i + k])) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    frequent = {p: k for (p, k) in f.items() if len(p[1]) > 1 and k >= min_count}
    covered = {(lang, p[i:i + m]) for (lang, p), k in frequent.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * k >= percent * f[lang, p[i:i + m]]}
    out = defaultdict(list)
    for (lang, p), a in frequent.items():
        if (lang, p) not in covered:
            score, _, left, right = min((Fraction(1000 * a * n[lang], f[lang, p[:k]] * f[lang, p[k:]]).__floor__(), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize("bits", [64, 6])
def test_collocations_equal_brute_force(spark, docs, corpus, bits):
    """With fingerprints of six bits hardly any phrase has one of its own, and the texts decide."""
    every = docs.select("doc_id", "text", "lang").unionByName(corpus.where("doc_id < 60").select("doc_id", "text", "lang"))
    texts = [(r["lang"], r["text"]) for r in every.collect()]
    for options in ({"min_count": 8, "top": 40}, {"min_count": 5, "max_words": 3, "percent": 60, "top": 10_000}):
        got = rows_of(collocations.collocations(every, print_bits=bits, **options))
        want = best_phrases(texts, options.get("max_words", 5), options["min_count"], options["top"], options.get("percent", 100))
        assert len(got) == len(want) > 40 and set(got) == want


def test_collocations_of_little(docs):
    assert rows_of(collocations.collocations(docs.where("false"))) == []
    assert rows_of(collocations.collocations(docs.where("text is null"))) == []
    # one word over and over: every pair is the same phrase
    got = rows_of(collocations.collocations(docs))
    assert {(r[0], r[2], r[3]) for r in got} == {("de", "spelling spelling", 3999), ("de", "spelling spelling spelling", 3998), ("de", "spelling " * 3 + "spelling", 3997), ("de", "spelling " * 4 + "spelling", 3996)}


def test_scores_beyond_64_bits(spark):
    """1000 * a * n of counts above 2**31 is exact."""
    found = spark.createDataFrame([("en", 2, "x y", 3_000_000_019), ("en", 1, "x", 3_000_000_037), ("en", 1, "y", 4_000_000_007)], "lang string, words tinyint, phrase string, n long")
    totals = spark.createDataFrame([("en", 9_000_000_000_001)], "lang string, n long")
    real = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a, **k: (found, totals)
        (row,) = rows_of(collocations.collocations(None))
    finally:
        collocations.frequent_phrases = real
    assert row[-1] == 1000 * 3_000_000_019 * 9_000_000_000_001 // (3_000_000_037 * 4_000_000_007)


def test_filters_hold_all_of_a_set(spark):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 64, 50_000, dtype=np.uint64)
    df = spark.createDataFrame([(int(x),) for x in prints[:5000].view(np.int64)], "print long")
    for most, others in ((28, 0.05), (12, 1.01)):
        found = word_stream.print_filter(df, "print", most)
        assert found.bits <= most and found.holds(prints[:5000]).all() and found.holds(prints[5000:]).mean() < others
    assert not word_stream.print_filter(df.where("false"), "print").holds(prints).any()


def test_words_in_segments():
    rolling = [word_stream.Rolling(1), word_stream.Rolling(2)]
    values = [b"Some words ", b"", "wörter".encode() * 40, b"a b c some"]
    whole, cut = (word_stream.words_of(values, collocations.BLANK, rolling, segment=s) for s in (1 << 20, 16))
    for a, b in zip((whole.starts, whole.ends, whole.text, *whole.prints), (cut.starts, cut.ends, cut.text, *cut.prints)):
        assert a.tolist() == b.tolist()
    assert whole.prints[0][0] == whole.prints[0][-1] and whole.prints[0][0] != whole.prints[1][0]


# ---- decontamination --------------------------------------------------------------

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def hits(text, items, size):
    """Hit words by comparing every window with every place."""
    words = re.findall(WORD, (text or "").translate(SMALL))
    hit, names = set(), set()
    for name, item in items:
        w = re.findall(WORD, (item or "").translate(SMALL))
        if name is None or not w:
            continue
        m = min(size, len(w))
        windows = {tuple(w[i:i + m]) for i in range(len(w) - m + 1)}
        for i in range(len(words) - m + 1):
            if tuple(words[i:i + m]) in windows:
                hit |= set(range(i, i + m))
                names.add(str(name))
    return len(words), hit, sorted(names)


def digest(doc, text, items, size):
    n, hit, names = hits(text, items, size)
    return (doc, n, len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_words", [250_000, 40])
def test_hits_equal_brute_force(spark, seed, max_words):
    """Texts over few words, items shorter and longer than a window, and many automata."""
    rng = random.Random(seed)
    text = lambda n: rng.choice([" ", ", ", "-\n"]).join(rng.choice(["a", "B", "b", "c7", "é", "dd"][:2 + seed * 2]) for _ in range(n))
    items = [(k, text(rng.choice([0, 2, 3, 4, 5, 9, 60]) if seed else rng.choice([6, 7, 30]))) for k in range(12)] + [(3, text(6)), (None, text(5)), (99, None), (98, ""), (5, text(5)), (5, text(5))]
    docs = [(k, text(rng.randrange(40))) for k in range(60)] + [(1, None), (None, text(20)), (None, "")]
    got = rows_of(decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), size=4, max_words=max_words))
    assert Counter(got) == Counter(digest(d, t, items, 4) for d, t in docs)


def test_hits_of_odd_documents(spark, docs, corpus):
    bench = spark.read.parquet(f"{DIR}/benchmark.parquet").withColumns({"w": F.lit(1), "item": F.lit(2), "at": F.lit(3)})
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    planted = (50, "before that. " + items[0][1] + " and after", "en")
    every = docs.select("doc_id", "text", "lang").unionByName(corpus.where("doc_id < 40").select("doc_id", "text", "lang")).unionByName(spark.createDataFrame([planted], "doc_id long, text string, lang string"))
    texts = [(r["doc_id"], r["text"]) for r in every.collect()]
    got = rows_of(decontamination.contamination(every, bench))
    assert Counter(got) == Counter(digest(d, t, items, 10) for d, t in texts) and any(r[0] == 50 and r[-1] for r in got)
    assert rows_of(decontamination.contamination(docs.where("false"), bench)) == []
    none = rows_of(decontamination.contamination(docs, bench.where("false")))
    assert Counter(none) == Counter(digest(d, t, [], 10) for d, t, _ in ODD)
    assert {c: str(t) for c, t in decontamination.contamination(docs, bench).dtypes}["contaminated"] == "boolean"


def test_words_with_one_fingerprint_stay_apart(monkeypatch, spark):
    """If all words had one fingerprint, the words themselves would decide."""
    real = decontamination.words_of

    def same(values, *args):
        found = real(values, *args)
        found.prints = [np.zeros(len(p), np.uint64) for p in found.prints]
        return found

    automaton = decontamination.Automaton([("1", "one two three four".split())], 3)
    monkeypatch.setattr(decontamination, "words_of", same)
    blind = decontamination.Automaton([("1", "one two three four".split())], 3)
    assert len(set(blind.prints.tolist())) == 1 and len(set(automaton.prints.tolist())) == 4
    assert blind.stream([blind.words.get(w, -1) for w in "one two three five two three four".split()])[0] == [(0, 3), (4, 7)]


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([
        (1, "Keep this, please and all of that too. One two THREE four five six seven eight nine ten! And this as well, it is fine.", 7), (2, item, 8), (3, None, 9), (4, "", 1), (5, "clean", 2),
        (6, "the short item is here: tiny thing, in a longer text", 3)], "doc_id long, text string, text_len long")
    bench = spark.createDataFrame([(1, item), (2, "tiny thing")], "item_id long, text string")
    got = {r["doc_id"]: (r["text"], r["text_len"]) for r in decontamination.without_spans(docs, bench).collect()}
    assert got == {1: ("Keep this, please and all of that too. ! And this as well, it is fine.", 7), 3: (None, 9), 4: ("", 1), 5: ("clean", 2), 6: ("the short item is here: tiny thing, in a longer text", 3)}
    assert decontamination.without_spans(docs, bench, max_span=2).where("doc_id = 6").first()["text"] == "the short item is here: , in a longer text"
    only = decontamination.without_spans(docs.select("text"), bench)
    assert only.columns == ["text"] and only.count() == 5
