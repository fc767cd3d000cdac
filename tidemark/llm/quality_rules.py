"""Quality rules: a decision list learned by sequential covering.

Text statistics, the learning and the verdict are DataFrame operations only.
Each step of the learning is one aggregate over a bounded table of labelled
statistics: it counts, for every threshold condition at once, how many low- and
high-quality rows the growing rule would still cover. The result is an ordered
list of threshold conjunctions, applied as one conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import as_row, materialize, of_row

#: Words are what stands between these characters.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_upper", "n_marks", "n_bangs", "n_stops", "n_adjacent"]
FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(n_words, 1)",
    "bang_share": "n_bangs / greatest(n_words, 1)",
    "stop_share": "n_stops / greatest(n_words, 1)",
    "adjacent_share": "n_adjacent / greatest(n_words, 1)",
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and not inlined."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are sorted by fingerprint and place; a window that has an equal
    neighbour is repeated. Its three words count unless the repeated window
    before it has covered them, so the sum runs over sorted places.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), p - F.get(places, i - 1))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeated(windows: Column) -> Column:
        same = lambda i: (F.get(windows, i)["h"] == F.get(windows, i + 1)["h"])
        mine = F.filter(windows, lambda w, i: F.coalesce(same(i), F.lit(False)) | (F.when(i > 0, F.coalesce(same(i - 1), F.lit(False))).otherwise(False)))
        return _let(F.array_sort(F.transform(mine, lambda w: w["i"])), covered)

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        windows = F.transform(starts, lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        # most texts repeat nothing: tell by their distinct fingerprints
        return _let(windows, lambda x: F.when(
            F.size(F.array_distinct(F.transform(x, lambda y: y["h"]))) == F.size(x), F.lit(0).cast("long"))
            .otherwise(_let(F.sort_array(x), repeated)))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(of_words(words))


def _count_of(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add the statistics of whole texts to ``docs``; a null text counts as empty.

    Columns with the names of statistics are replaced, all others stay.
    """
    names = [c for c in docs.columns if c not in {*STATISTICS, *EXTRA}]
    docs = docs.select(as_row(docs).alias("row"), "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    bare = F.translate(text, BLANKS, "")
    out = docs.withColumns({
        "counts": _let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))).cast("long").alias("n_adjacent"))),
        "word_chars": F.char_length(bare).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_upper": _count_of(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_marks": _count_of(text, ".,;:!?"),
        "n_bangs": _count_of(text, "!"),
        "n_stops": _count_of(text, ".?"),
    })
    within = ("n_words", "n_repeat_words", "n_adjacent")
    return out.select(*of_row("row", names), *(F.col(f"counts.{c}" if c in within else c).alias(c) for c in [*STATISTICS, *EXTRA]))


def held_statistics(docs: DataFrame) -> DataFrame:
    """``with_statistics`` for a filter: it comes out of a generator, which filters don't move below.

    Below the statistics each mention of one would be the whole expression over the text again.
    """
    found = with_statistics(docs)
    names = [*STATISTICS, *EXTRA]
    return found.select(*(c for c in found.columns if c not in names), F.inline(F.array(F.struct(*names))))


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.above else '<'} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the document is rejected."""

    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional: the first rule that holds rejects."""
    text = " ".join(f"WHEN {r.sql()} THEN false" for r in rules)
    return F.expr(f"CASE {text} ELSE true END") if rules else F.lit(True)


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Statistics of at most ``max_rows`` labelled documents, chosen by hash.

    The chosen ids are bounded by ``max_rows`` and so may be broadcast; only
    their documents are measured. Labels other than 0 and 1 are left out.
    """
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .select(F.col("doc_id").alias("_id"), F.col("quality").alias("_good")).groupBy("_id").agg(F.min("_good").alias("_good"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return materialize(with_statistics(texts).select(
        F.col("_good").alias("good"), F.pmod(F.xxhash64("_id", F.lit("prune")), F.lit(3)).alias("fold"), *STATISTICS, *EXTRA))


def learn(table: DataFrame, max_rules: int = 8, max_conditions: int = 3, n_thresholds: int = 24,
          min_precision: float = 0.97, min_cover: int = 5) -> list[Rule]:
    """Sequential covering over labelled statistics.

    Grows each rule condition by condition on two thirds of the rows by FOIL
    gain, prunes its last conditions while that does not lower its precision on
    the last third, keeps it if it is precise enough there, and goes on with
    the rows that it doesn't cover. Thresholds are quantiles of all rows and of
    the low-quality ones; the rows' bins between them are computed once, and a
    step counts (feature, bin, label), from which the counts of all threshold
    conditions follow. Returns no rules where there are no low-quality rows.
    """
    levels = [i / n_thresholds for i in range(1, n_thresholds)]
    quantiles = [F.percentile_approx(F.expr(e).cast("double"), levels, 1000).alias(f) for f, e in FEATURES.items()]
    found = [rows.agg(*quantiles).first() for rows in (table, table.where("good = 0"))]
    cuts = {f: sorted({float(t) for row in found for t in row[f] or []}) for f in FEATURES}
    cuts = {f: c for f, c in cuts.items() if c}
    if not cuts:
        return []

    def bin_of(f: str) -> Column:
        value = F.expr(FEATURES[f]).cast("double")
        return _let(value, lambda v: F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda t: v >= t)))

    binned = materialize(table.select("good", "fold", *(bin_of(f).alias(f) for f in cuts)))
    names = list(cuts)

    def holds(c: tuple[str, bool, int]) -> Column:
        return F.col(c[0]) >= c[2] if c[1] else F.col(c[0]) < c[2]

    def counts_of_all(rows: DataFrame) -> list[tuple[tuple[str, bool, int], int, int]]:
        bins = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(f).alias("b")) for i, f in enumerate(names))))
        got = rows.select("good", bins.alias("x")).groupBy("x.f", "x.b").agg(
            F.count_if(F.col("good") == 0).alias("bad"), F.count_if(F.col("good") == 1).alias("fine")).collect()
        out = []
        for i, f in enumerate(names):
            mine = [(r["b"], r["bad"], r["fine"]) for r in got if r["f"] == i]
            for k in range(1, len(cuts[f]) + 1):
                for above in (True, False):
                    within = [m for m in mine if (m[0] >= k) == above]
                    out.append(((f, above, k), sum(m[1] for m in within), sum(m[2] for m in within)))
        return out

    def both(rows: DataFrame, tests: list[Column]) -> list[tuple[int, int]]:
        aggs = [F.count_if(t & (F.col("good") == g)).alias(f"c{i}_{g}") for i, t in enumerate(tests) for g in (0, 1)]
        row = rows.agg(*aggs).first()
        return [(row[f"c{i}_0"], row[f"c{i}_1"]) for i in range(len(tests))]

    rules: list[Rule] = []
    rest = binned
    while len(rules) < max_rules:
        chosen: list[tuple[str, bool, int]] = []
        covered = rest.where("fold != 0")
        (bad, good), = both(covered, [F.lit(True)])
        while bad >= min_cover and good and len(chosen) < max_conditions:
            best, most = None, 0.0
            for c, b, g in counts_of_all(covered):
                if b >= min_cover:
                    gain = b * (log2(b / (b + g)) - log2(bad / (bad + good)))
                    if gain > most:
                        best, most = (c, b, g), gain
            if best is None:
                break
            c, bad, good = best
            chosen.append(c)
            covered = covered.where(holds(c))
        if not chosen:
            break
        heads = [holds(chosen[0])]
        for c in chosen[1:]:
            heads.append(heads[-1] & holds(c))
        on_prune, on_all = both(rest.where("fold = 0"), heads), both(rest, heads)
        k = -max(((b + 1) / (b + g + 2), -i) for i, (b, g) in enumerate(on_prune))[1]
        b, g = on_all[k]
        if b < min_cover or b / (b + g) < min_precision:
            break
        rules.append(Rule(tuple(Condition(f, above, cuts[f][at - 1]) for f, above, at in chosen[:k + 1])))
        rest = rest.where(~heads[k])
    return rules


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> list[Rule]:
    """Learn from a bounded sample of labelled rows outside the held-out third."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return learn(labelled_statistics(docs, labels.where(~held_out), max_rows))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with statistics, base_failed and kept.

    Null and empty texts have no words and fail the base rules; a very long text
    is measured whole; repeated rows are judged each on their own, and ties with
    a threshold fall on its upper side; extra columns stay, but columns with the
    names of statistics and of the verdict are replaced. An empty table gives no
    rows.
    """
    return with_statistics(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that the base rules and the learned list keep, columns unchanged."""
    rows = docs.select(as_row(docs).alias("row"), "text")
    return judge(rows, rules).where("kept").select(*of_row("row", docs.columns))
