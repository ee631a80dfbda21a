"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power a, normalised; a = 1 keeps the natural
mix, a = 0 makes all sources equal.  The exponent is bisected in [0, 1]: it is the least
one at which the mix's entropy is at most ``entropy_share`` of the largest possible and no
source is repeated more than ``max_repeat`` times within the budget.  One job settles
several halvings at once; what reaches the driver is a handful of sums.

The weights become token quotas.  A source runs through as many full passes as its quota
holds, then through part of one more.  In every pass the source's blocks (a text belongs to
one by hash, about ``BLOCK`` texts each) and the texts in a block are permuted by hash; the
last pass stops before the text that would overrun the quota.  Running sums go over the
totals of runs of ``BLOCK`` blocks first, over the blocks of a run then, and inside single
blocks last, so no task holds a source or all of its blocks.

All of it is DataFrame expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import stable

ENTROPY_SHARE, MAX_REPEAT = 0.97, 4.0
BLOCK = 1000
HALVINGS, AT_ONCE = 40, 5
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words between blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _meets(shares: DataFrame, points: list[float], most_entropy: float, times: float) -> list[bool]:
    """For each exponent: is the mix peaked enough, and no source repeated too often?"""
    power = F.pow("p", F.col("a"))
    rows = shares.select("p", F.explode(F.array(*[F.lit(a) for a in points])).alias("a")).groupBy("a").agg(
        F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("e"), F.max(F.pow("p", F.col("a") - 1)).alias("r")).collect()
    good = {a: math.log(z) - a * e / z <= most_entropy and r / z * times <= 1.0 + 1e-12 for a, z, e, r in rows}
    return [good[a] for a in points]


def exponent(shares: DataFrame, count: int, entropy_share: float = ENTROPY_SHARE, max_repeat: float = MAX_REPEAT, budget_ratio: float = 1.0) -> float:
    """The exponent for ``shares(p)`` of ``count`` sources; ``budget_ratio`` is budget over all tokens."""
    if count < 2:
        return 1.0
    most, times = entropy_share * math.log(count), budget_ratio / max_repeat
    if _meets(shares, [0.0], most, times)[0]:
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(HALVINGS // AT_ONCE):
        grid = [low + (high - low) * k / (1 << AT_ONCE) for k in range(1, 1 << AT_ONCE)]
        good = _meets(shares, grid, most, times)
        first = next((k for k, g in enumerate(good) if g), len(grid))
        low, high = ([low] + grid)[first], (grid + [high])[first]
    return high


def _hash(*parts) -> Column:
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", budget: int | None = None, seed: int = 0,
        entropy_share: float = ENTROPY_SHARE, max_repeat: float = MAX_REPEAT, block: int = BLOCK, carry: list[str] | None = None,
        names: tuple[str, str, str] = ("n_tokens", "pass", "block")) -> DataFrame:
    """The mixed rows: the columns ``carry`` (default all), and tokens, pass and block under ``names``.

    A row stands once for each pass that takes it; passes count from 0.  ``budget`` is in
    tokens, by default as many as ``docs`` has.  A null source is the source ''.  A source
    without tokens gets no rows; texts without words cost nothing.  Equal rows of one key
    are ordered as one.  A column of the input called like one of ``names`` is replaced.
    """
    taken = {n.lower() for n in names}
    kept = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in taken]
    rows = docs.select(F.struct(*[f"`{c}`" for c in kept]).alias("row"), F.col(key).alias("key"),
                       F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"), token_count(F.col(text)).alias("n"))
    sized = docs.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"), token_count(F.col(text)).alias("n"))
    sources = stable(sized.groupBy("src").agg(F.sum("n").alias("tokens"), F.count("*").alias("texts")))
    whole = sources.filter("tokens > 0").agg(F.sum("tokens"), F.count("*")).first()
    total, count = whole[0] or 0, whole[1]
    budget = total if budget is None else budget
    shares = sources.filter("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    a = exponent(shares, count, entropy_share, max_repeat, budget / max(total, 1))
    z = shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    quota = F.floor(F.pow("p", F.lit(a)) / F.lit(z) * F.lit(float(budget)) + 1e-6).cast("long")
    plan = stable(shares.withColumn("quota", quota).select(
        "src", F.ceil(F.col("texts") / block).cast("long").alias("blocks"),
        F.floor(F.col("quota") / F.col("tokens")).cast("long").alias("full"), F.pmod("quota", "tokens").alias("rest")))

    place = F.conv(F.substring(_hash(F.lit(seed), F.lit("block"), F.col("key")), 1, 8), 16, 10).cast("long")
    dealt = rows.join(plan, "src").withColumn("block", F.pmod(place, F.col("blocks")))
    # Tokens that stand before each block in the source's last, partial pass.
    small = docs.select(F.col(key).alias("key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"), token_count(F.col(text)).alias("n"))
    totals = small.join(plan, "src").groupBy("src", F.pmod(place, F.col("blocks")).alias("block"), "full", "blocks").agg(F.sum("n").alias("n"))
    # Runs cut the order of the blocks' hashes into equal ranges, so the order over all is the same.
    shuffled = _hash(F.lit(seed), F.col("full"), F.col("src"), F.col("block"))
    run = F.floor(F.conv(F.substring("turn", 1, 8), 16, 10).cast("long") * F.ceil(F.col("blocks") / BLOCK) / F.lit(float(1 << 32)))
    totals = stable(totals.withColumn("turn", shuffled).withColumn("run", run))
    runs = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.groupBy("src", "run").agg(F.sum("n").alias("sum")).select("src", "run", F.coalesce(F.sum("sum").over(runs), F.lit(0)).alias("ahead"))
    turn = Window.partitionBy("src", "run").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    within = totals.select("src", "block", "run", F.coalesce(F.sum("n").over(turn), F.lit(0)).alias("within"))
    before = within.join(ahead, ["src", "run"]).select("src", "block", (F.col("ahead") + F.col("within")).alias("before"))
    inside = Window.partitionBy("src", "block").orderBy(_hash(F.lit(seed), F.col("full"), F.col("key")), "key", "n").rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.join(before, ["src", "block"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))
    passes = (F.col("full") + F.when(F.col("upto") <= F.col("rest"), 1).otherwise(0)).cast("int")
    made = ranked.filter(passes > 0).withColumn("pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    return made.select("row.*", F.col("n").alias(names[0]), F.col("pass").alias(names[1]), F.col("block").alias(names[2]))
