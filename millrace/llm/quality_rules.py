"""Quality rules whose cutoffs are certified on labelled texts.

Every rule rejects a text when a ratio of two of its counts exceeds a cutoff.  Within a
stratum (here: the language) a cutoff is certified if the labelled good texts that it
rejects prove, by the exact binomial tail, that its false rejection rate is at most
``ALPHA / number of rules``; so all rules together reject at most ``ALPHA`` of the good.
Cutoffs are tested from the mildest on and testing ends at the first failure, which needs
no correction; over rules and strata the level ``DELTA`` is split evenly (Bonferroni).
Of the certified cutoffs a rule takes the one with the best balance of bad against good
texts rejected, and none if that is not positive.  A stratum without labels has no rules.

All of it is DataFrame expressions.  Counts per text are made in the row, whatever its
length; the labelled texts are aggregated to one row per stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stable

ALPHA, DELTA = 0.05, 0.05
PENALTY = 20.0
MIN_WORDS, MAX_REPEAT = 20, 30
SPAN = 8
BLANK = r"\x20\x09-\x0D"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

# rule: counted, out of, cutoffs in thousandths from the mildest
RULES = {
    "symbols": ("n_symbols", "n_words", (800, 500, 300, 200, 100, 50)),
    "dup_lines": ("n_dup_lines", "n_lines", (600, 400, 300, 200, 100, 50)),
    "repeats": ("n_repeat_words", "n_words", (300, 250, 200, 150, 100, 50)),
    "upper": ("n_upper", "word_chars", (800, 600, 400, 300, 200, 100)),
    "long_words": ("word_chars", "n_words", (20000, 15000, 12000, 10000, 9000, 8000)),
}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column, span: int) -> Column:
    """Words that stand in a run of ``span`` words found more than once, its first place included.

    Runs are told apart by a 64-bit hash; where some hash repeats, neighbours in hash order
    are compared word by word.
    """
    def run(i):
        return F.slice(words, i + 1, F.lit(span))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - span), lambda i: F.xxhash64(run(i)))

    def cover(h):
        pairs = F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("p"))))

        def marked(s):
            def twin(x, y):
                return F.coalesce((y["h"] == x["h"]) & (run(x["p"]) == run(y["p"])), F.lit(False))

            # Only an entry with an equal neighbour can be a repeat.
            return F.transform(s, lambda x, i: F.when(twin(x, F.get(s, i - 1)) | twin(x, F.get(s, i + 1)), x["p"]))

        places = F.sort_array(F.filter(_let(pairs, marked), lambda p: p.isNotNull()))
        start = F.struct(F.lit(-span).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(places, start, lambda acc, p: F.struct(
            p.alias("last"), (acc["total"] + F.least(F.lit(span), p - acc["last"])).alias("total")), lambda acc: acc["total"])

    return F.when(F.size(words) < span, F.lit(0).cast("long")).otherwise(_let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(cover(h))))


def counts(text: Column, span: int = SPAN) -> Column:
    """A struct of ``COUNTS`` of the whole text; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANK}]"))

    def both(words):
        return F.struct(F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        _repeated_words(words, span).alias("n_repeat_words"))

    by_word = _let(F.regexp_extract_all(text, F.lit(f"[^{BLANK}]+"), F.lit(0)), both)
    by_line = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    left = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")
    return F.struct(by_word.alias("word"), by_line.alias("line"), left("#*$%&|<>").alias("n_symbols"), left("A-Z").alias("n_upper"))


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "rules", span: int = SPAN) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a struct ``name`` of the counts and base_failed, written once.

    A column called ``name`` is replaced.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != name.lower()]
    raw = stable(docs.select(*[f"`{c}`" for c in names], counts(F.col(text), span).alias(name)))
    at = {c: F.col(f"`{name}`.{'word.' if c in ('n_words', 'word_chars', 'n_repeat_words') else 'line.' if 'lines' in c else ''}{c}") for c in COUNTS}
    failed = (at["n_words"] < MIN_WORDS) | (100 * at["n_repeat_words"] > MAX_REPEAT * at["n_words"])
    return raw.withColumn(name, F.struct(*[at[c].alias(c) for c in COUNTS], failed.alias("base_failed")))


def _exceeds(name: str, rule: str, cutoff: Column) -> Column:
    over, of, _ = RULES[rule]
    return 1000 * F.col(f"`{name}`.{over}") > cutoff * F.col(f"`{name}`.{of}")


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series, shifted up by ten for accuracy."""
    z = x + 11.0
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5))
    return series - sum((F.log(x + float(k)) for k in range(1, 11)), F.lit(0.0))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(at most k of n) at ``rate``, exact; 1 where k is not below the mean.

    Terms are summed downwards from k; those more than fifty deviations below are under
    any double's precision.
    """
    n, k = n.cast("double"), k.cast("double")
    from math import log

    first = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * log(rate) + (n - k) * log(1 - rate))
    depth = F.least(k, F.ceil(50 * F.sqrt(n * rate * (1 - rate)) + 50)).cast("long")
    ratio = (1 - rate) / rate
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(acc, j):
        i = k - j + 1
        term = acc["term"] * i / (n - i + 1) * ratio
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(depth < 1, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), F.greatest(depth, F.lit(1).cast("bigint"))))
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(first * F.aggregate(steps, start, add, lambda acc: acc["total"]))


def certify(texts: DataFrame, labels: DataFrame, stratum: Column, key: str = "doc_id", good: str = "quality", name: str = "rules",
            alpha: float = ALPHA, delta: float = DELTA, penalty: float = PENALTY) -> DataFrame:
    """One row per stratum: ``stratum`` and the cutoff of every rule (null: the rule is off).

    ``texts`` are measured.  A key with several labels is good if one of them says so;
    labels that are null, have no text, or belong to a text that fails the base rules
    are not used.
    """
    marks = labels.filter(F.col(key).isNotNull() & F.col(good).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.max(good).alias("__good"))
    used = texts.filter(~F.col(f"`{name}`.base_failed")).join(marks, F.col(key) == F.col("__key")).withColumn("stratum", stratum)
    sums = []
    for rule, (_, _, cutoffs) in RULES.items():
        for c in cutoffs:
            for label in (0, 1):
                hit = _exceeds(name, rule, F.lit(c)) & (F.col("__good") == label)
                sums.append(F.sum(hit.cast("long")).alias(f"{rule}_{c}_{label}"))
    totals = [F.sum((F.col("__good") == label).cast("long")).alias(f"n_{label}") for label in (0, 1)]
    table = stable(used.groupBy("stratum").agg(*totals, *sums))
    cells = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"{rule}_{c}_0").alias("bad"), F.col(f"{rule}_{c}_1").alias("kept_out"))
        for rule, (_, _, cutoffs) in RULES.items() for c in cutoffs])
    level = delta / (len(RULES) * max(1, table.count()))
    rows = table.select("stratum", "n_0", "n_1", F.explode(cells).alias("cell")).select("stratum", "n_0", "n_1", "cell.*")
    rows = rows.withColumn("p", binomial_tail(F.col("n_1"), F.col("kept_out"), alpha / len(RULES)))
    gain = F.col("bad") / F.greatest("n_0", F.lit(1)) - penalty * F.col("kept_out") / F.greatest("n_1", F.lit(1))
    mild = Window.partitionBy("stratum", "rule").orderBy(F.col("cutoff").desc())
    rows = rows.withColumn("worst", F.max("p").over(mild)).withColumn("gain", gain).filter((F.col("worst") <= level) & (F.col("gain") > 0))
    best = Window.partitionBy("stratum", "rule").orderBy(F.col("gain").desc(), F.col("cutoff").desc())
    rows = rows.withColumn("__n", F.row_number().over(best)).filter("__n = 1")
    chosen = [F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(r) for r in RULES]
    return stable(rows.groupBy("stratum").agg(*chosen))


def judge(texts: DataFrame, cutoffs: DataFrame, stratum: Column, name: str = "rules") -> DataFrame:
    """Measured texts with ``kept`` in their struct: false for base_failed or a ratio above a cutoff."""
    carried = texts.withColumn("__stratum", stratum)
    limits = cutoffs.select(F.col("stratum").alias("__at"), F.struct(*RULES).alias("__limits"))
    joined = carried.join(limits, F.col("__stratum") == F.col("__at"), "left")
    over = F.lit(False)
    for rule in RULES:
        over = over | F.coalesce(_exceeds(name, rule, F.col(f"__limits.{rule}")), F.lit(False))
    kept = ~F.col(f"`{name}`.base_failed") & ~over
    return joined.withColumn(name, F.col(f"`{name}`").withField("kept", kept)).select(*texts.columns)


def apply(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang", name: str = "rules",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the struct ``name``: counts, base_failed and kept.

    A null stratum is one of its own.  Null and empty texts fail the base rules.  Repeated
    rows are judged alike.  An empty table of labels leaves the base rules alone.
    """
    level = F.coalesce(F.col(stratum), F.lit(""))
    texts = measured(docs, text, keep, name)
    return judge(texts, certify(texts, labels, level, key, name=name), level, name)
