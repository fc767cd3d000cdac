"""The training-data operators against brute force, round trips and edge cases."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, license_scan, line_dedup, ngram_join, packing, quality_classifier, quality_rules, token_counts, token_files, topk_search
from tidemark.llm import queries as q
from tidemark.llm._common import scratch_dir
from tidemark.llm.tokens import WordEncoder, default_tokenizer

DIR = "/root/testdata/sf0.001"
WORDS = "[^\x20\x09-\x0d]+"
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "same words here again"), (5, "same words here again"), (6, "same words here again"),
    (7, "Don't STOP: 123 naïve Ünïcode ΣΑΣ ǅ J̌ İ"), (8, "a<|endoftext|>b <|STARTOFTEXT|>"), (9, "x" * 3000), (910, "word " * 5000), (11, "🎉🎉 \x85y\x1cz\x00"), (None, "no id"),
    (12, "Line one of eight words is here now ok\nshort\nLine one of eight words is here now ok"), (13, "MIT License, apache LICENSE; General Public License.\nmit license"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with further columns whose names clash with results."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    return df.withColumns({"n_words": F.lit("clash"), "score": F.lit("clash"), "kept": F.lit(1), "size": F.lit(0), "_id": F.lit(2),
                           "_drop": F.lit(3), "_counts": F.lit(4), "_row": F.lit(5), "row": F.lit(6), "id": F.lit(7), "drop": F.lit("x"), "a.b": F.lit(8), "edits": F.lit(9), "n_upper": F.lit(10)}).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


@functools.cache
def own_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def tokens_of(text):
    return own_library().encode(text or "", add_special_tokens=False).ids


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def every(corpus, docs):
    return [(r["doc_id"], r["text"]) for r in corpus.collect()] + ODD


# ---- tokens ---------------------------------------------------------------------


def some_texts(seed, n):
    """Short texts of characters on which normalizers and pre-tokenizers differ."""
    rng = random.Random(seed)
    pools = ["abcXYZ 'stSTredlv\n\t.,!<|>09", "aàÀßŸÿ×÷Þþ é'É", "".join(map(chr, range(0x250))), "\u0301\u0307\u0345ÅAaİi ΣΑς'", "\x85 \xa0\u3000ab\x1c\x1fc", "\u0899\u08d1\u1ac0a", "ab,1  "]
    tokens = ["<|endoftext|>", "<|STARTOFTEXT|>", "don't", "Don'T", "it'S", "a<|b", "é'é"]
    for _ in range(n):
        pool = rng.choice(pools)
        yield "".join(rng.choice(rng.choice(pools)) if rng.random() < 0.1 else rng.choice(tokens) if rng.random() < 0.05 else rng.choice(pool) for _ in range(rng.randrange(40)))


def every_letter(step):
    return [f"a{chr(c)}b1" for c in range(1, 0x110000, step) if not 0xD800 <= c < 0xE000]


def test_word_encoder_equals_library(library, corpus):
    enc = WordEncoder(default_tokenizer(), max_words=500)
    rows = [t for _, t in every(corpus, None)] + list(some_texts(1, 3000)) + every_letter(7)
    want = [e.ids for e in library.encode_batch_fast([t or "" for t in rows], add_special_tokens=False)]
    for at in range(0, len(rows), 700):
        ids, sizes = enc.encode_column(pa.array(rows[at:at + 700], pa.string()))
        ends = np.cumsum(sizes)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == want[at:at + 700]
    assert enc.encode_column(pa.array([], pa.string()))[1].tolist() == []


def test_word_encoder_of_another_file():
    """Files that split in another way are encoded by whole texts."""
    from tokenizers import Tokenizer

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, rows = WordEncoder(path), ["Two  words", None, "don't\n STOP"]
    ids, sizes = enc.encode_column(pa.array(rows))
    lib = Tokenizer.from_file(path)
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in rows]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    (chars, tokens), = enc.leaves(["Two  words"])
    assert chars.tolist() == [10] and tokens.tolist() == [len(want[0])]


def test_counts_under_edits_equal_a_full_encoding(library, docs, none):
    edits = token_counts.revision_edits()
    got = token_counts.count_with_edits(docs, edits, with_text=True).collect()
    assert len(got) == len(ODD)
    by_before = Counter((r["doc_id"], r["n_tokens"]) for r in got)
    assert by_before == Counter((d, len(ids_of(library, t))) for d, t in ODD)
    for r in got:
        assert r["n_tokens_after"] == len(ids_of(library, r["text"])) and r["n_chars_after"] == len(r["text"])
        assert r["n_encoded_chars"] <= (200 if r["doc_id"] != 9 else 3 * 3100)  # a word of 3,000 letters is one pre-token
    assert token_counts.count_with_edits(none, edits).count() == 0


def test_random_edits_on_a_tree(library):
    enc = WordEncoder(default_tokenizer())
    rng = random.Random(4)
    for text in [t or "" for _, t in ODD] + list(some_texts(2, 150)):
        (chars, tokens), = enc.leaves([text])
        tree, now = token_counts.SegmentTree(text, chars, tokens, enc.pieces_of, crowded=rng.choice([4, 64])), text
        for new in some_texts(rng.random(), 10):
            at, n, new = rng.randrange(len(now) + 3), rng.choice([0, 1, 7, 300]), rng.choice(["", " ", "ab", "x y\nz ", "\n", "'", "<|endoftext|>", new])
            tree.edit(at, n, new)
            at = min(at, len(now))
            now = now[:at] + new + now[at + n:]
            flat, chars, tokens = tree.flat()
            assert flat == now and tree.n_tokens == tokens.sum() == len(ids_of(library, now)) and chars.sum() == tree.n_chars == len(now)


def test_edits_encode_what_they_touch():
    """Without spaces too, and again and again at one place."""
    enc = WordEncoder(default_tokenizer())
    text = ",".join(["ab1"] * 25_000)
    (chars, tokens), = enc.leaves([text])
    tree = token_counts.SegmentTree(text, chars, tokens, enc.pieces_of)
    tree.edit(50_000, 1, "x")
    assert tree.encoded_chars < 10
    for _ in range(50):
        tree.edit(50_000, 0, "inserted text 1")
    assert tree.encoded_chars < 50 * 30


def test_kept_trees_take_edits(spark, library, docs, corpus):
    """A stored table of trees is updated without encoding what edits leave alone."""
    both = corpus.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    path = scratch_dir(spark)
    token_counts.build_trees(both).write.parquet(path)
    edits = F.array(F.struct(F.lit(3).alias("start"), F.lit(2).alias("length"), F.lit("new words ").alias("replacement")))
    trees = spark.read.parquet(path)
    for _ in range(2):
        got = token_counts.update_trees(trees, edits)
        trees = got.select(trees.columns)
    rows = got.collect()
    assert len(rows) == both.count()
    for r in rows:
        assert r["n_tokens"] == sum(r["leaf_tokens"]) == len(ids_of(library, r["text"])) and sum(r["leaf_chars"]) == len(r["text"])
        assert r["n_encoded_chars"] < 100 or r["doc_id"] in (9, 910)


def test_attached_edits(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    docs = docs.withColumn("edits", F.lit("clash"))
    edits = spark.createDataFrame([(1, 1, 0, 3, "1"), (1, 2, 2, 3, "2"), (9, 1, 0, 0, "x")], "doc_id long, seq int, start long, length long, replacement string")
    out = token_counts.count_with_edits(token_counts.attach_edits(docs, edits), F.col("edits"), with_text=True)
    assert {r["doc_id"]: (r["text"], r["n_edits"]) for r in out.collect()} == {1: ("1 2", 2), 2: ("three", 0)}


def test_token_files_round_trip(spark, library, docs, corpus):
    both = corpus.select("doc_id", "text").unionByName(docs.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text"))
    path = scratch_dir(spark)
    token_files.write_token_files(both, path)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    want = sorted(((None if d is None else d, ids_of(library, t) + [2]) for d, t in [(r["doc_id"], r["text"]) for r in both.collect()]), key=lambda x: (x[0] is not None, x[0] or 0, len(x[1])))
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    assert [r["start"] for r in got] == list(itertools.accumulate([0] + [r["n_tokens"] for r in got][:-1]))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((d, tuple(i)) for d, i in want)
    crcs = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in token_files.read_token_files(spark, path, digest=True).collect()}
    for r in got:
        assert crcs[r["doc_id"], r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    # files follow each other in doc_id order
    spans = spark.read.parquet(f"{path}/shards").groupBy(F.input_file_name().alias("f")).agg(F.min("start").alias("a"), F.max("start").alias("b")).orderBy("f").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_token_files_of_nothing(none):
    assert token_files.token_file_digests(none).count() == 0


def test_token_files_of_a_heavy_id(spark, library):
    """A doc_id with a third of all rows, and rows without one, go to several files in doc_id order."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} " * (1 + i % 5)) for i in range(600)]
    path = scratch_dir(spark)
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path)
    got = token_files.read_token_files(spark, path).withColumn("f", F.input_file_name()).orderBy("start").collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((d, (*ids_of(library, t), 2)) for d, t in rows)
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r["start"] for r in got] == list(itertools.accumulate([0] + [r["n_tokens"] for r in got][:-1]))
    files = spark.read.parquet(f"{path}/shards").groupBy(F.input_file_name()).agg(F.sum("n_tokens").alias("n")).collect()
    assert len(files) == 4 and max(r["n"] for r in files) < 0.5 * sum(r["n"] for r in files)


def test_codes_of_many_symbols():
    """More than 65,536 ids get longer code words; every id comes back."""
    n = 70_000
    bits = token_files.bits_for(n)
    counts = np.arange(1, n + 1)
    ids = np.arange(n) * 3
    book = token_files.Codebook(ids, token_files.limited_lengths(counts, bits), bits)
    assert bits > 16 and token_files.bits_for(1 << 16) == 16
    text = np.random.default_rng(3).permutation(ids)
    sizes = np.array([0, 1, 300, n - 301])
    payloads, checkpoints = book.encode(text, sizes)
    assert (book.decode(payloads, checkpoints, sizes) == text).all()
    with pytest.raises(ValueError):
        token_files.bits_for(1 << 26)


def test_limited_code_is_optimal_and_bounded():
    rng = np.random.default_rng(1)
    for n, bits in ((1, 4), (2, 4), (9, 4), (16, 4), (300, 12), (300, 16)):
        counts = np.maximum(1, (1e6 * rng.random(n) ** 12)).astype(np.int64)
        lengths = token_files.limited_lengths(counts, bits)
        assert lengths.max() <= bits and (n == 1 or (2.0 ** -lengths).sum() == 1)
    import heapq

    heap, total = [int(c) for c in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        total += x
        heapq.heappush(heap, x)
    assert total <= int((counts * lengths).sum()) <= total * 1.01


def test_bpe_equals_library(library, docs, corpus):
    codec = bpe.RankArrayBpe(default_tokenizer(), max_words=100)
    for _, text in every(corpus, docs):
        ids = ids_of(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert codec.encode(text or "") == ids and codec.decode(ids) == decoded
        assert codec.digest(text or "") == (len(ids), " ".join(map(str, ids)), decoded)


def test_bpe_on_every_letter(library):
    codec = bpe.RankArrayBpe(default_tokenizer())
    rows = every_letter(5) + list(some_texts(3, 5000))
    for text, want in zip(rows, library.encode_batch_fast(rows, add_special_tokens=False)):
        assert codec.encode(text) == want.ids, ascii(text)


def test_bpe_query_on_odd_documents(library, docs, none):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((d, len(i := ids_of(library, t)), sha(" ".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False))) for d, t in ODD)
    assert Counter(map(tuple, bpe.round_trip_digests(docs).collect())) == want
    assert bpe.round_trip_digests(none).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((d, library.decode(ids_of(library, t), skip_special_tokens=False)) for d, t in ODD)


def test_long_words_merge_like_short_ones(library):
    codec = bpe.RankArrayBpe(default_tokenizer())
    rng = random.Random(2)
    for n in (255, 256, 257, 4000):
        word = "".join(rng.choice("aehinrst") for _ in range(n))
        assert codec.encode(word) == ids_of(library, word)


# ---- packing ----------------------------------------------------------------------


def check_packing(got, capacity):
    groups = defaultdict(list)
    for r in got:
        groups[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in groups.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(groups)


def test_packing(library, docs, none, corpus):
    both = corpus.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    got = packing.pack_documents(both, capacity=512).collect()
    n = check_packing(got, 512)
    total = sum(r["length"] for r in got)
    assert total == sum(len(ids_of(library, r["text"])) + 1 for r in both.collect())
    assert n <= -(-total // 512) * 1.05 + 1
    for r in got:
        assert r["piece"] * 512 == r["start"]
    one = [r for r in got if r["doc_id"] == 910]
    ids = ids_of(library, ODD[10][1]) + [0]
    assert sorted((r["start"], r["ids_crc32"]) for r in one) == [(s, zlib.crc32(np.array(ids[s:s + 512], "<u4").tobytes())) for s in range(0, len(ids), 512)]
    assert packing.pack_documents(none).count() == 0


def test_plan_equals_best_fit_one_by_one():
    rng = random.Random(3)
    for _ in range(30):
        capacity = rng.choice([10, 64, 200])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
        free = []
        for x in sorted(lengths, reverse=True):
            fits = [f for f in free if f >= x]
            if fits:
                free.remove(best := min(fits))
                free.append(best - x)
            else:
                free.append(capacity - x)
        plan = packing.plan_best_fit(dict(Counter(lengths)), capacity)
        used = {s + k for _, _, n, each, s, _ in plan for k in range(-(-n // each))}
        assert len(used) == len(free) and sum(n for _, _, n, *_ in plan) == len(lengths)


# ---- quality -------------------------------------------------------------------------


def statistics_of(text):
    text = text or ""
    w = re.findall(WORDS, text)
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(WORDS, line):
            copies += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


def test_statistics_and_verdicts(spark, docs, none, corpus):
    rules = quality_rules.train(corpus, spark.read.parquet(f"{DIR}/labels.parquet"))
    both = corpus.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    for r in quality_rules.judge(both, rules).collect():
        want = statistics_of(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    kept = quality_rules.keep_good(docs, rules)
    assert kept.columns == docs.columns and kept.where("n_words <> 'clash'").count() == 0
    assert quality_rules.judge(none, rules).count() == 0


def test_rules_find_planted_junk(spark):
    good = [(i, " ".join(f"w{(i * 7 + j * j) % 991}" for j in range(120)) + ".") for i in range(300)]
    junk = [(1000 + i, " ".join(f"w{(i * 5 + j * j) % 991}###" for j in range(120))) for i in range(100)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, quality_rules.train(docs, labels)).collect()}
    assert all(got[i] == (i < 1000) for i in got)
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.scored(docs, model).collect()
    assert all((r["predicted"] == 1) == (r["doc_id"] < 1000) for r in scored) and model.rules


def features_of(text):
    """The statistics behind learned rules, each by its own definition."""
    text = text or ""
    n, chars, symbols, copies, repeated = statistics_of(text)
    w = re.findall(WORDS, text)
    count = lambda some: sum(text.count(c) for c in some)
    of = lambda x, y: x / max(y, 1)
    return {
        "n_words": n, "mean_word": of(chars, n), "symbol_share": of(symbols, chars), "dup_lines": copies, "repeat_share": of(repeated, n), "symbols_per_word": of(symbols, n),
        "upper_share": of(count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), "mark_share": of(count(".,;:!?"), n), "bang_share": of(count("!"), n), "stop_share": of(count(".?"), n),
        "adjacent_share": of(sum(a == b for a, b in zip(w, w[1:])), n)}


def kept_by(rules, text):
    """The verdict of a decision list: the first rule that holds rejects."""
    n, _, _, _, repeated = statistics_of(text)
    if n < 50 or 100 * repeated > 50 * n:
        return False
    f = features_of(text)
    return not any(all((f[c.feature] >= c.threshold) == c.above for c in r.conditions) for r in rules)


def score_by(model, text):
    f = features_of(text)
    odds = model.intercept + sum(w for path, w in model.rules if all((f[x] <= t) == (side == "<=") for x, side, t in path))
    return 1 / (1 + np.exp(-odds))


def test_learned_verdicts_and_scores_equal_plain_python(spark, docs, corpus):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    both = corpus.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    rules, model = quality_rules.train(corpus, labels), quality_classifier.train(corpus, labels)
    assert rules and model.rules
    verdicts = quality_rules.judge(both, rules).select("text", "kept").collect()
    assert all(r["kept"] == kept_by(rules, r["text"]) for r in verdicts)
    # a list that splits the texts, so that rules decide and not the base
    made = [quality_rules.Rule((quality_rules.Condition("mean_word", True, 4.7), quality_rules.Condition("stop_share", False, 0.11))), quality_rules.Rule((quality_rules.Condition("upper_share", True, 0.03),))]
    verdicts = quality_rules.judge(both, made).select("text", "kept").collect()
    assert all(r["kept"] == kept_by(made, r["text"]) for r in verdicts) and len({r["kept"] for r in verdicts}) == 2
    rows = {r["text"]: r["score"] for r in quality_classifier.with_statistics(both.select("text")).withColumn("score", model.score()).select("text", "score").collect()}
    assert all(abs(score - score_by(model, text)) < 1e-12 for text, score in rows.items()) and len(set(rows.values())) > 2


def test_paths_are_those_of_the_tree(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(200).selectExpr("cast(id % 20 as double) a", "cast(id % 7 as double) b", "cast((id % 20 > 9 and id % 7 > 2) or id % 20 > 15 as int) label")
    tree = DecisionTreeClassifier(featuresCol="x", maxDepth=3).fit(VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(rows))
    found = list(quality_classifier.paths(tree, ["a", "b"]))
    assert len(found) == tree.numNodes - 1
    leaves = [p for p in found if not any(set(p) < set(q) and len(q) > len(p) for q in found)]
    for a, b in itertools.product(range(20), range(7)):
        held = [p for p in leaves if all(({"a": a, "b": b}[f] <= t) == (side == "<=") for f, side, t in p)]
        assert held


def test_learning_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.train(docs, none) == []
    assert {r["score"] for r in quality_classifier.scored(docs, quality_classifier.train(docs, none)).collect()} == {0.5}


def test_classifier_on_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = quality_classifier.scored(docs, quality_classifier.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in got]
    assert len(right) > 50 and sum(right) / len(right) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


# ---- licenses ---------------------------------------------------------------------------


def test_license_base_places(docs, none, corpus):
    both = corpus.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    texts = defaultdict(list)
    for r in both.collect():
        texts[r["doc_id"]].append(r["text"])
    for r in license_scan.scan(both).collect():
        found = []
        for text in texts[r["doc_id"]]:
            w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            at, own = [], set()
            for phrase, label in license_scan.PHRASES.items():
                p = phrase.split()
                here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
                at += here
                own |= {label} if here else set()
            found.append((len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own))))
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in found
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert license_scan.scan(none).count() == 0


@pytest.mark.parametrize("text, accepted", [
    ("Released under the MIT License.", True), ("released under the terms of the mit license", True), ("released under terms of the mit license", False),
    ("Released under the MIT-style License", False), ("x licensed licensed under the mit license y", True), ("released under the mit", False)])
def test_template_regions(text, accepted):
    a = license_scan.Automaton(license_scan.TEMPLATES[0][2])
    assert a.accepts(license_scan.WORD.findall(text.lower().encode())) == accepted


def as_pattern(markup):
    """A template as a regular expression over words that each end in a space."""
    out = ""
    for m in license_scan.marks(markup):
        if m == "[[":
            out += "(?:"
        elif m == "]]":
            out += ")?"
        elif m[0] == "{":
            out += f"(?:[^ ]+ ){{0,{m[1:-1]}}}" if m[1:-1].isdigit() else f"(?:{m[1:-1]}) "
        else:
            out += re.escape(m) + " "
    return re.compile("(?:^| )" + out)


def test_labels_equal_an_independent_matcher(spark, corpus, docs):
    """Whole texts with their regions filled in or left out are accepted, those with one mandatory word altered are not."""
    rng = random.Random(11)
    patterns = [(label, score, as_pattern(markup)) for label, score, markup in license_scan.TEMPLATES]
    rows = [(d, t) for d, t in every(corpus, docs) if d is not None]
    for label, _, markup in license_scan.TEMPLATES:
        if not label.endswith("-text"):
            continue
        for k in range(8):
            words, depth = [], 0
            for m in license_scan.marks(markup):
                depth += (m == "[[") - (m == "]]")
                if m[0] == "{":
                    words += [[f"any{i}" for i in range(rng.randrange(int(m[1:-1]) + 1))]] if m[1:-1].isdigit() else [[rng.choice(m[1:-1].split("|"))]]
                elif m[0] not in "[]" and (not depth or k % 2):
                    words.append(m if not depth else [m])
            if k > 1:
                at = rng.choice([i for i, w in enumerate(words) if isinstance(w, str)])
                words[at] = "altered"
            text = rng.choice([" ", ", ", "\n"]).join(x.upper() if k % 3 else x for w in words for x in ([w] if isinstance(w, str) else w))
            rows.append((1_000_000 + len(rows), f"{label} {k}\n{text}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    accepted = Counter()
    got = {(r["doc_id"], r["labels"], r["score"]) for r in license_scan.scan(df).collect()}
    for d, text in rows:
        w = "".join(x.decode() + " " for x in license_scan.WORD.findall((text or "").encode().lower()))
        base = {v for p, v in license_scan.PHRASES.items() if f" {p} " in " " + w}
        more = {label: score for label, score, p in patterns if p.search(w)}
        assert (d, ",".join(sorted(base | set(more))), max(more.values(), default=0.5 if base else 0.0)) in got, text
        if d >= 1_000_000:
            label, k = text.split("\n")[0].split(" ")
            accepted[label, int(k) < 2] += label in more
    whole = [label for label, score, _ in license_scan.TEMPLATES if score == 1]
    assert all(accepted[label, True] == 2 and accepted[label, False] == 0 for label in whole)


def test_replaceable_words():
    a = license_scan.Automaton("this {2} is [[really]] ours")
    for text, ok in (("this is ours", True), ("this x is ours", True), ("this x y is really ours", True), ("this x y z is ours", False), ("this x is truly ours", False)):
        assert a.accepts(text.encode().split()) == ok


# ---- near copies --------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall(WORDS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def near_copies(seed, n_groups=25):
    rng, rows = random.Random(seed), []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 5, 14, 60, 200]))]
        for _ in range(rng.choice([1, 2, 4, 20])):
            b = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(b) // 15])):
                b[rng.randrange(len(b))] = f"w{rng.randrange(300)}"
            rows.append((len(rows), rng.choice([" ", "\n ", "\t"]).join(b)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, "One"), (len(rows) + 4, "one"), (0, rows[0][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).repartition(4)
    assert Counter(map(tuple, ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect())) == brute_components(rows)


def test_components_by_shuffles(spark, monkeypatch):
    """Tables of more keys than are broadcast give the same rows, at every place that joins by keys."""
    rows = near_copies(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    real = ngram_join.with_keys
    joined = []
    monkeypatch.setattr(ngram_join, "FEW_KEYS", 0)
    monkeypatch.setattr(ngram_join, "with_keys", lambda df, keys, column, few=0: joined.append(column) or real(df, keys, column, 0))
    assert Counter(map(tuple, ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect())) == brute_components(rows)
    assert joined


def test_sets_with_one_fingerprint_stay_apart(spark):
    """Sets that share their first fingerprint are told apart by the second."""
    rows = near_copies(5, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    first = ngram_join.measured(df, 5).where("kind = 0")
    local, shared = ngram_join.class_keys(first.select("doc_id", "print", F.col("key").bitwiseAND(F.lit(3)).alias("key"), "check", "size"))
    assert len(shared) == 4 and local.select("key").distinct().count() == first.select("check").distinct().count()


def test_pairs_within_a_passage_grow_with_its_documents(spark):
    """Documents that share a passage but don't link are never paired off, whatever their number."""
    common = " ".join(f"common{j}" for j in range(19))
    met = {}
    for n in (1000, 4000):
        df = spark.createDataFrame([(i, " ".join(f"own{i}x{j}" for j in range(5)) + " " + common) for i in range(n)], "doc_id long, text string").repartition(4)
        ranked = ngram_join.frequent_shingles(ngram_join.measured(df, 5).where("kind = 1"), 1000)
        assert len(ranked) >= 15
        shared = ngram_join.sharers(ngram_join.prefixes(df, 5, 75, ranked, np.empty(0, np.int64)))
        assert shared.count() >= n
        rooted = shared.withColumns({"root": F.col("key"), "leader_root": F.col("leader_key")})
        met[n] = ngram_join.repair_pairs(rooted, 75).count()
        got = ngram_join.near_duplicates(df)
        assert got.where("doc_id = component_id").count() == n
    assert met == {1000: 0, 4000: 0}


def test_size_limits_are_what_may_link_allows(spark):
    df = spark.range(1, 61).selectExpr("id as s").crossJoin(spark.range(1, 61).selectExpr("id as u")).crossJoin(spark.range(0, 20).selectExpr("id as t")).where("t < s")
    low, high = ngram_join.size_limits(F.col("s"), F.col("t"), 75)
    ok = ngram_join.may_link(F.col("s"), F.col("t"), F.col("u"), F.lit(0), 75)
    assert df.where(ok != F.col("u").between(low, high) & (F.least("u", F.col("s") - F.col("t")) >= ngram_join.required_overlap(F.col("s"), F.col("u"), 75))).count() == 0
    assert df.where(ok & ~F.col("u").between(low, high)).count() == 0
    c = ngram_join.size_class
    assert spark.range(1, 5000).where(c(F.col("id")) > c(F.col("id") + 1)).count() == 0


def test_components_with_a_hub(spark):
    links = [(i, 500) for i in range(200)] + [(500, 3), (900, 901), (901, 902)]
    df = spark.createDataFrame(links, "a long, b long")
    got = [dict(map(tuple, ngram_join.components(df, hub).collect())) for hub in (10, 1_000_000)]
    assert got[0] == got[1] == {**{i: 0 for i in [*range(200), 500]}, 900: 900, 901: 900, 902: 900}


def test_one_of_each_group_stays(spark, docs, none):
    rows = near_copies(3, 10)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("mine"))
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    want = {c for d, _, c in brute_components(rows)}
    blank = sum(d not in {x for x, t in rows if t and t.strip()} for d, _ in rows)
    assert blank == 3 and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    by_shuffles = ngram_join.keep_one(df, few=0)
    assert Counter(map(tuple, by_shuffles.collect())) == Counter(map(tuple, kept.collect()))
    odd = ngram_join.keep_one(docs)
    assert odd.columns == docs.columns and odd.where("doc_id is null").count() == 1 and odd.where("doc_id in (5, 6)").count() == 1
    assert ngram_join.near_duplicates(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_texts_of_one_id_and_rows_without_one(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    df = spark.createDataFrame([(1, a), (1, b), (1, b), (2, b + " more"), (None, a + " more"), (None, c), (None, c + " more"), (3, None), (3, None), (None, " ")], "doc_id long, text string")
    kept = ngram_join.keep_one(df).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter({(1, a): 1, (1, b): 1, (3, None): 2, (None, " "): 1, next((None, t) for t in (c, c + " more") if any(r["text"] == t for r in kept)): 1})
    got = Counter((r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect())
    assert got == Counter({(1, 1): 3, (2, 1): 1, (None, 1): 1, (None, None): 3, (3, 3): 2})


def test_long_data_in_segments():
    text = (b"some words  of\tmany lengths \xc3\xa9t\xc3\xa9 " * 200) + b"\n"
    data = np.frombuffer(text, np.uint8)
    a, b = ngram_join.word_prints(data), ngram_join.word_prints(data, segment=64)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and len(a[0]) == len(text.split())


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    a, b = (np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64)) for _ in range(2))
    b = np.unique(np.concatenate([b[:100], a[:200]]))
    sketches = ngram_join.parity_sketches(np.concatenate([a, b]), np.array([len(a), len(b)])).to_pylist()
    bits = sum(bin((x ^ y) & (2 ** 64 - 1)).count("1") for x, y in zip(*sketches))
    assert bits <= len(np.setxor1d(a, b))


# ---- lines -----------------------------------------------------------------------------------


def test_lines_recurring_in_other_documents_go(spark):
    shared = "this passage of nine words stands in many documents"
    field = "report number {} of the daily sales meeting was sent to {}"
    rows = [(1, f"first own line of this document is here now\n{shared}"), (2, f"{shared}\nsecond own line of that document is here now"),
            (3, f"{shared}\n{shared}"), (4, field.format(11, "anna")), (5, field.format(12, "boris") + "\nshort line"), (6, "short line"), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("drop", F.lit("x")).withColumn("n_lines", F.lit(9))
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["clean_text"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got[1] == (2, 0, rows[0][1]) and got[2] == (2, 1, "second own line of that document is here now") and got[3] == (2, 2, "")
    assert got[4][1] == 0 and got[5] == (2, 1, "short line") and got[6] == (1, 0, "short line") and got[7] == (0, 0, None) and got[8] == (1, 0, "")
    kept = line_dedup.without_recurring_lines(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 4, 5, 6, 7, 8}


def test_all_exact_lines_are_dropped(corpus):
    """Every line of eight words or more that an earlier document holds goes."""
    rows = [(r["doc_id"], r["text"] or "") for r in corpus.collect()]
    first = {}
    for d, text in sorted(rows):
        for line in text.split("\n"):
            first.setdefault(line, d)
    dropped = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(corpus).collect()}
    for d, text in rows:
        exact = sum(len(re.findall(WORDS, x)) >= 8 and first[x] < d for x in text.split("\n"))
        assert exact <= dropped[d]  # and lines of near copies, which differ in a field


def test_texts_of_one_id_lose_their_own_lines(spark):
    """Two texts under one doc_id: what recurs in the first doesn't cost the second its line there."""
    shared, own = "this passage of nine words stands in many documents", "a unique line of nine words that nobody holds"
    df = spark.createDataFrame([(3, shared), (5, f"{shared}\nmore"), (5, f"{own}\n{own} too"), (5, f"{own}\n{own} too")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_dropped"], r["clean_text"]) for r in line_dedup.dedup_lines(df).collect())
    assert got == sorted([(3, 0, shared), (5, 1, "more"), (5, 0, f"{own}\n{own} too"), (5, 0, f"{own}\n{own} too")])


def dropped_lines(rows, min_words=8, depth=3, similarity=0.8, min_docs=2, short_min_docs=3):
    """The same tree line by line: (doc_id, text) -> numbers of the lines that go."""
    leaves, prints = defaultdict(dict), {}
    for d, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            w = tuple(re.findall(WORDS, "".join(c.lower() if c.isascii() else c for c in line)))
            if not w or text is None:
                continue
            masked = tuple("<field>" if re.search("[0-9]", x) else x for x in w)
            need = -(-round(len(w) * similarity * 1000) // 1000)
            general = len(w) - masked.count("<field>") >= need
            key = masked if general else w
            leaf = (len(w), key[:depth])
            prints[d, text, i] = (leaf, key, general)
            leaves[leaf].setdefault((key, general), set()).add(d)
    template = {}
    for leaf, variants in leaves.items():
        keys = list(variants)
        root = {k: k for k in keys}

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        need = -(-round(leaf[0] * similarity * 1000) // 1000)
        for a, b in itertools.combinations([k for k in keys if k[1]], 2):
            if sum(x == y != "<field>" for x, y in zip(a[0], b[0])) >= need:
                root[find(a)] = find(b)
        for k in keys:
            template[leaf, k] = (leaf, find(k))
    holders = defaultdict(set)
    for (leaf, k), t in template.items():
        holders[t] |= leaves[leaf][k]
    out = defaultdict(set)
    for (d, text, i), (leaf, key, general) in prints.items():
        own = holders[template[leaf, (key, general)]]
        if len(own) >= (min_docs if leaf[0] >= min_words else short_min_docs) and d > min(own):
            out[d, text].add(i)
    return out


def test_dropped_lines_equal_brute_force(spark, corpus):
    """Which lines go, both ways, on whole documents with numbers, copies and short lines."""
    rng = random.Random(5)
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    rows += [(90_000 + i, "\n".join(rng.choice(["report {} of the daily sales meeting was sent to {}", "Home {}", "see you there", "the total of {} {} {} {} units", "all of these words {} come back again {} and again"]).format(
        *(rng.choice([rng.randrange(40), "anna", "boris", "the"]) for _ in range(4))) for _ in range(4))) for i in range(60)]
    want = dropped_lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for r in line_dedup.dedup_lines(df).collect():
        gone = want.get((r["doc_id"], r["text"]), set())
        clean = r["text"] and "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
        assert (r["n_dropped"], r["clean_text"]) == (len(gone), clean if gone else r["text"])
    assert sum(map(len, want.values())) > 100


def test_lines_of_odd_documents(docs, none):
    out = line_dedup.dedup_lines(docs)
    assert out.count() == len(ODD) and out.where("doc_id = 12").first()["n_dropped"] == 0
    assert line_dedup.dedup_lines(none).count() == 0


def dropped_of(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["n_dropped"] for r in line_dedup.dedup_lines(df, **options).orderBy("doc_id").collect()]


@pytest.mark.parametrize("line", ["the weekly report for {a} was sent to all of us", "your order for {a} from {b} has been shipped by our team today"])
def test_recurring_values_of_a_field(spark, line):
    """A field stays one though each of its values is in two documents."""
    names, cities = (["".join(x) for x in itertools.islice(itertools.product(letters, repeat=2), 40)] for letters in ("abcdefg", "hijklmn"))
    texts = [line.format(a=names[i % 40], b=cities[(i + i // 40) % 40]) for i in range(80)]
    assert dropped_of(spark, texts) == [0] + [1] * 79
    rng = random.Random(4)
    others = ["the weekly report for " + " ".join(rng.choices("pqrstuvw", k=7)) for _ in range(30)]
    assert sum(dropped_of(spark, [*others, *texts])) == 79 + sum(dropped_of(spark, others))


def test_line_links_equal_brute_force(spark):
    """Every line that links with an earlier document's goes, over chains of links."""
    rng = random.Random(7)
    texts = [" ".join(["one", "two", "three", *rng.choices("abc", k=rng.choice([5, 9, 12, 17]))]) for _ in range(120)]
    lines = [x.split() for x in texts]
    root = list(range(len(lines)))
    for _ in lines:
        for i, j in itertools.combinations(range(len(lines)), 2):
            if len(lines[i]) == len(lines[j]) and 10 * sum(x == y for x, y in zip(lines[i], lines[j])) >= 8 * len(lines[i]):
                root[i] = root[j] = min(root[i], root[j])
    want = [int(root.index(r) < i) for i, r in enumerate(root)]
    assert dropped_of(spark, texts) == want and 10 < sum(want) < 110


def test_comparisons_grow_with_the_lines(spark, monkeypatch):
    """Lines that open alike and go on differently aren't all compared with each other."""
    made = []
    real = line_dedup.similar_pairs

    def counting(pairs, *args):
        made[-1] += pairs.distinct().count()
        return real(pairs, *args)

    monkeypatch.setattr(line_dedup, "similar_pairs", counting)
    for n in (250, 1000):
        rng = random.Random(n)
        own = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(8))
        texts = ["please note that our new offer for " + own() for _ in range(n)]
        texts += [texts[7][:-6] + "klmnop", texts[9][:-6] + "klmnop"]
        made.append(0)
        assert dropped_of(spark, texts) == [0] * n + [1, 1]
    assert made[1] < 6 * made[0] and made[1] < 6000


def test_split_keys_lose_no_link(spark):
    """Keys that are split early and often give the links of brute force."""
    rng = random.Random(11)
    texts = [" ".join(["one", "two", "three", *rng.choices("abc", k=rng.choice([6, 9, 12])), *rng.choices("xy", k=3)]) for _ in range(200)]
    rows = list(enumerate(texts))
    want = dropped_lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    leaves = line_dedup.shared_leaves(line_dedup.line_variants(line_dedup.lines(df, 3, 0.8)))
    words = line_dedup.line_words(df, 3, 0.8, leaves).dropDuplicates(["print"]).cache()
    groups = [{r["print"]: r["template"] for r in line_dedup.templates(words, 3, 0.8, apart=k).collect()} for k in (8, 64)]
    assert groups[0] == groups[1] and len(set(groups[0].values())) > 10
    assert sum(dropped_of(spark, texts)) == sum(map(len, want.values()))


def test_lines_with_one_print_are_told_apart(spark, monkeypatch):
    """If all prints were one, the second fingerprint would still tell different lines from equal ones."""
    real = line_dedup.lines
    monkeypatch.setattr(line_dedup, "lines", lambda *a: real(*a).withColumn("print", F.lit(5).cast("long")))
    texts = ["a line of eight words that is unique once", "another line of eight words that stands twice here", "another line of eight words that stands twice here", "three words here", "three words here"]
    assert dropped_of(spark, texts) == [0, 0, 1, 0, 0]
    assert dropped_of(spark, texts, short_min_docs=2) == [0, 0, 1, 0, 1]


def test_short_lines_of_many_documents_go(spark):
    """Lines of every length are looked at; short ones need three documents, counted over all."""
    texts = ["Home\nown words here", "Home\nAll rights reserved.\nall of us were there", "Home\nAll rights reserved.", "all RIGHTS reserved.\n\nwe were there", "we were there\nHome", "\n", "\n"]
    assert dropped_of(spark, texts) == [0, 1, 2, 1, 1, 0, 0]
    passage = "\n".join(f"seven words are in this line {x}" for x in "abcdefgh")
    assert dropped_of(spark, [passage] * 3) == [0, 8, 8]
    assert dropped_of(spark, texts, short_min_docs=2) == [0, 1, 2, 1, 2, 0, 0]


def test_rows_of_numbers_are_not_one_template(spark):
    """Masked fields are no constant words: rows of a table stay, unless they are the same."""
    row, other = "2021 14 15.5 3 8 77 41 9", "1998 20 11.2 6 5 31 90 4"
    assert dropped_of(spark, [row, other, other, row[:-1] + "8"]) == [0, 0, 1, 0]
    assert dropped_of(spark, ["sales of 12 34 56 78 90 11 12 units", "sales of 98 76 54 32 10 22 21 units"]) == [0, 0]
    assert dropped_of(spark, ["page 1 of 2"] * 2 + ["page 3 of 9", "page 1 of 2"]) == [0, 1, 0, 1]
    df = spark.createDataFrame([(1, row), (2, other)], "doc_id long, text string")
    assert line_dedup.without_recurring_lines(df).count() == 2


# ---- vectors ----------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(0, 0.2, (230, 8)).astype(np.float32)
    base[50:120] = base[0]
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(base)]
    rows += [(500, None, "x"), (501, [float("nan")] * 8, "x"), (502, [None] * 8, "x"), (550, [float("inf")] + [0.0] * 7, "x"), (None, [0.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)
    whole = np.floor(256 * base.astype(np.float64)).astype(np.int64)
    want = set()
    for i in range(0, 230, 50):
        s = whole @ whole[i]
        best = sorted((j for j in range(230) if j != i), key=lambda j: (-s[j], j))[:5]
        want |= {(i, k + 1, j, int(s[j])) for k, j in enumerate(best)}
    assert set(map(tuple, topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect())) == want
    assert topk_search.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert topk_search.top_k(few, F.col("vec_id") == 0).count() == 2


def test_top_k_of_clusters_and_shuffled_rows(spark, monkeypatch):
    """Clusters, many equal vectors, repeated rows and two widths, over several cells; the same rows however they are dealt."""
    rng = np.random.default_rng(8)
    middles = rng.normal(0, 1, (12, 6))
    base = np.concatenate([middles[rng.integers(0, 12, 5000)] + rng.normal(0, 0.05, (5000, 6)), np.tile(middles[0], (1500, 1))])
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(7, base[7].tolist())] * 3 + [(90_000 + i, rng.normal(0, 1, 3).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = set()
    for width in (6, 3):
        own = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows if len(v) == width]
        ids, whole = np.array([i for i, _ in own]), np.stack([v for _, v in own])
        for q in sorted({i for i in ids.tolist() if i % 50 == 0}):
            s = whole @ whole[np.flatnonzero(ids == q)[0]]
            best = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:5]
            want |= {(q, r + 1, int(ids[j]), int(s[j])) for r, j in enumerate(best)}
    got = topk_search.top_k(df.repartition(5), F.col("vec_id") % 50 == 0).collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)
    again = topk_search.top_k(df.orderBy(F.rand(1)).repartition(3), F.col("vec_id") % 50 == 0).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_few_scores_are_computed():
    """On clusters, with a score to beat, a small part of all pairs is looked at."""
    rng = np.random.default_rng(9)
    middles = rng.normal(0, 200, (40, 8))
    v = np.floor(middles[np.repeat(np.arange(40), 100)] + rng.normal(0, 8, (4000, 8)))
    ask = np.arange(0, 4000, 50)
    scores = v[ask] @ v.T
    scores[np.arange(len(ask)), ask] = -np.inf
    worst = np.sort(scores, 1)[:, -5]
    data, queries = topk_search.CoverTree(np.arange(4000), v), topk_search.CoverTree(ask, v[ask], leaf=4)
    for known in (None, worst):
        best, computed = topk_search.search(queries, [data], 5, known)
        ids, _, found = best.result()
        assert len(ids) == 5 * len(ask) and computed < 0.35 * len(ask) * 4000
        assert sorted(found.tolist()) == sorted(np.sort(scores, 1)[:, -5:].astype(np.int64).ravel().tolist())


@pytest.mark.parametrize("spread", [50, 1])
def test_levels_of_a_cover_tree(spread):
    """Nodes cover their points by level, children lie apart by it and have lower ones; the first has its parent's center."""
    rng = np.random.default_rng(7)
    v = np.floor(rng.normal(0, 300, (20, 6))[rng.integers(0, 20, 900)] + rng.normal(0, spread, (900, 6)))
    t = topk_search.CoverTree(np.arange(900), v)
    assert sorted(t.ids.tolist()) == list(range(900)) and max(map(len, t.children)) > 1
    for c, r, level, (a, b), children in zip(t.center, t.radius, t.level, t.span, t.children):
        away = np.sqrt(((t.vectors[a:b] - c) ** 2).sum(1)).max()
        assert away == r and (r == 0 if level is None else 2.0 ** (level - 1) < r <= 2.0 ** level)
        if children:
            cover = 2.0 ** (level - 1)
            assert all(t.level[x] is None or t.level[x] < level for x in children) and all(t.radius[x] <= cover for x in children)
            assert sorted(t.span[x] for x in children)[0][0] == a and sum(t.span[x][1] - t.span[x][0] for x in children) == b - a
            middles = np.array([t.center[x] for x in children])
            apart = np.sqrt(((middles[:, None] - middles) ** 2).sum(-1))[~np.eye(len(children), dtype=bool)]
            assert apart.min() > cover and any((m == c).all() for m in middles)


def test_packs_go_to_blocks(spark, monkeypatch):
    """Where nothing can be left out, a pack goes once to each shard, and no block moves again; rows are those of brute force."""
    rng = np.random.default_rng(12)
    base = rng.normal(0, 1, (6000, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk_search, "VECTORS", 512)
    monkeypatch.setattr(topk_search, "SHARD_BYTES", 3 * 512 * 8 * 4)
    monkeypatch.setattr(topk_search, "QUERIES", 64)
    monkeypatch.setattr(topk_search, "hopeless", lambda most, worst: most < -np.inf)
    moved = []
    real = topk_search.reaching

    def counting(packs, centers, shards):
        out = real(packs, centers, shards)
        n_shards = max(int(x.max()) for x in shards.last.values()) + 1
        moved.append((packs.count(), n_shards, out.count()))
        return out

    monkeypatch.setattr(topk_search, "reaching", counting)
    whole = np.floor(256 * base).astype(np.int64)
    want = set()
    for i in range(0, 6000, 50):
        s = whole @ whole[i]
        best = [j for j in np.lexsort((np.arange(6000), -s)) if j != i][:5]
        want |= {(i, k + 1, int(j), int(s[j])) for k, j in enumerate(best)}
    assert set(map(tuple, topk_search.top_k(df, F.col("vec_id") % 50 == 0).collect())) == want
    (n_packs, n_shards, sent), = moved
    assert n_shards > 3 and sent == n_packs * (n_shards - 1)


# ---- registered queries and the pipeline ----------------------------------------------------------


def test_sql_of_queries(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    for name, sql in q.ORACLE_SQL.items():
        df = q.QUERIES[name](spark, DIR)
        cursor = con.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert Counter(map(tuple, df.select(*columns).collect())) == Counter(cursor.fetchall()), name


def test_pipeline_equals_plain_python(spark, tmp_path):
    """Stage by stage on whole documents; only the learned models come from Spark."""
    import corpus_pipeline

    given, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    # near copies whose lines are no copies: a document in one line, with a word more
    copies = given.where("doc_id % 9 = 0").withColumns({"doc_id": F.col("doc_id") + 10_000, "text": F.concat(F.translate("text", "\n", " "), F.lit(" more"))})
    where = f"file://{tmp_path}"
    given.unionByName(copies).write.parquet(f"{where}/documents.parquet")
    labels.write.parquet(f"{where}/labels.parquet")
    raw, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    rules, model = quality_rules.train(raw, labels), quality_classifier.train(raw, labels)
    rows = [(r["doc_id"], r["text"]) for r in raw.select("doc_id", "text").collect()]
    rows = [(d, t) for d, t in rows if kept_by(rules, t)]
    rows = [(d, t) for d, t in rows if score_by(model, t) >= 0.5]
    gone = dropped_lines(rows)
    clean = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t]) if gone.get((d, t)) else t, bool(gone.get((d, t)))) for d, t in rows]
    rows = [(d, t) for d, t, cut in clean if not cut or re.search(WORDS, t)]
    sets = []
    for d, t in rows:
        w = re.findall(WORDS, "".join(c.lower() if c.isascii() else c for c in t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0:
            root[find(i)] = find(j)
    group = {d: find(i) for i, (d, _) in enumerate(rows)}

    got = corpus_pipeline.run(spark, where).collect()
    kept = {r["doc_id"] for r in got}
    assert kept <= set(group) and sorted(group[d] for d in kept) == sorted(set(group.values())) and len(kept) < len(rows)
    ids = {d: len(x) + 1 for d, x in zip([d for d, _ in rows], [tokens_of(t) for _, t in rows]) if d in kept}
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    assert all(sum(n for _, n in x) == ids[d] for d, x in pieces.items())
    assert len({r["sequence_id"] for r in got}) <= -(-sum(ids.values()) // 2048) + 2


def test_pipeline_keeps_clean_documents_once(spark):
    import corpus_pipeline as p

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        path = scratch_dir(spark)
        out.write.parquet(path)
        before, after = docs.count(), spark.read.parquet(path).count()
        assert 0 < after <= before, name
        docs = spark.read.parquet(path)
    found = ngram_join.near_duplicates(docs).collect()
    assert all(r["doc_id"] == r["component_id"] for r in found)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert docs.join(labels, "doc_id").where("quality = 0").count() == 0
    packed = p.pack_sequences(spark, docs, sf).collect()
    check_packing(packed, 2048)
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.select("doc_id").collect()}
