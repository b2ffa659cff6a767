"""Operator 3: mixing sources to target weights by temperature.

A source with share p of the tokens gets weight p^a / sum p^a.  The exponent a is
bisected: the largest one (closest to the natural mix) whose weights reach the
target entropy, given as a fraction of the entropy of equal weights; but never so
small that a source would be repeated more often than the repetition limit, which
takes precedence.  The budget is given in tokens, or is by default the least one at
which every source is read whole at least once.

Weights are then realised exactly in whole documents: a source's quota is so many
full epochs, and of the next epoch's permutation the longest prefix that stays
within what is left.  A permutation is an order of hashed keys.  Where its prefix
ends is found by radix selection: tokens by 4096 blocks of keys, by 4096 blocks in
the block where the quota ends, then by document in that one, so no task ever sees
a whole source, however hot.  Copies are dealt to output blocks of about
``BLOCK_TOKENS`` tokens by another hash and ordered within them.

Defined cases: tokens are words; null and empty sources are one source; null texts
have no tokens; a source without tokens is read once; documents alike in id and text
are taken together; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import staged, text_or_empty, words

TARGET_ENTROPY, REPETITION_LIMIT, SEED = 0.9, 4.0, 17
BLOCK_TOKENS = 1_000_000

#: Exponents tried in one pass (five bisections), and passes.
SECTIONS, PASSES = 32, 6

_DIGIT = 12  # bits of a radix digit


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, tie): what mixing needs to know of a document."""
    return docs.select("doc_id", _source(), F.size(words(text_or_empty())).cast("long").alias("n_tokens"), _tie())


def _source() -> Column:
    return F.coalesce("source", F.lit("")).alias("source")


def _tie() -> Column:
    return F.xxhash64(text_or_empty()).alias("tie")


def _key(epoch: Column, seed: int) -> Column:
    """Place of a document in an epoch's permutation: 63 bits."""
    return F.xxhash64(F.lit(seed), epoch, F.col("doc_id")).bitwiseAND(F.lit((1 << 63) - 1))


def exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY,
             repetition_limit: float = REPETITION_LIMIT, budget: float | None = None) -> tuple[float, float]:
    """The exponent and the budget in tokens, from (source, tokens).

    A pass sums p^a and p^a ln p for the exponents of two brackets in one
    aggregation over the sources; only those sums reach the driver.
    """
    shares = sources.filter("tokens > 0")
    one = shares.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.min("tokens").alias("lo"),
                     F.max("tokens").alias("hi")).first()
    if not one["n"]:
        return 1.0, float(budget or 0)
    total, low, high = float(one["t"]), one["lo"] / one["t"], one["hi"] / one["t"]
    target = target_entropy * math.log(one["n"])
    p = F.col("tokens") / F.lit(total)

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        row = shares.agg(*[f for i, a in enumerate(exponents) for f in (
            F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{i}"))]).first()
        return [(row[f"z{i}"], row[f"l{i}"]) for i in range(len(exponents))]

    def even(a: float, z: float, log: float) -> bool:  # entropy reaches the target
        return math.log(z) - a * log / z >= target - 1e-12

    def sparing(a: float, z: float, log: float) -> bool:  # no source is repeated too often
        b = budget if budget is not None else total * z * high ** (1 - a)
        return b / total * low ** (a - 1) / z <= repetition_limit + 1e-12

    entropy, repeat = [0.0, 1.0], [0.0, 1.0]
    for _ in range(PASSES):
        tried = [[x + (y - x) * k / SECTIONS for k in range(SECTIONS + 1)] for x, y in (entropy, repeat)]
        got = sums([*tried[0], *tried[1]])
        fit = [k for k, a in enumerate(tried[0]) if even(a, *got[k])]
        k = max(fit, default=0)
        entropy = [tried[0][k], tried[0][min(k + 1, SECTIONS)]]
        fit = [k for k, a in enumerate(tried[1]) if sparing(a, *got[SECTIONS + 1 + k])]
        k = min(fit, default=SECTIONS)
        repeat = [tried[1][max(k - 1, 0)], tried[1][k]]
    a = max(entropy[0], repeat[1])
    (z, _), = sums([a])
    return a, budget if budget is not None else total * z * high ** (1 - a)


def quotas(sources: DataFrame, a: float, budget: float) -> DataFrame:
    """(source, tokens, weight, full, rest): whole epochs and the tokens of the next."""
    total = sources.agg(F.sum("tokens").alias("t"), F.sum(F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a))))
                        .alias("z")).first()
    z = total["z"] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(a)) / F.lit(z)).otherwise(0.0)
    epochs = F.when(F.col("tokens") > 0, weight * F.lit(float(budget)) / F.col("tokens")).otherwise(1.0)
    out = sources.select("source", "tokens", weight.alias("weight"), epochs.alias("epochs"))
    out = out.withColumn("full", F.floor(F.col("epochs") + 1e-9).cast("long"))
    return out.withColumn("rest", F.greatest(F.lit(0.0), (F.col("epochs") - F.col("full")) * F.col("tokens")))


def _end(rows: DataFrame, by: list[str], digit: str, rest: str) -> DataFrame:
    """Of each group, the block of keys in which the quota ends, and what is left for it."""
    w = Window.partitionBy(*by).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(*by, digit).agg(F.sum("n_tokens").alias("n"), F.max(rest).alias("rest"))
    over = sums.withColumn("upto", F.sum("n").over(w)).filter(F.col("upto") > F.col("rest"))
    return (over.groupBy(*by).agg(F.min(F.struct(digit, (F.col("rest") - F.col("upto") + F.col("n")).alias("rest")))
                                  .alias("m")).select(*by, F.col(f"m.{digit}").alias(digit), F.col("m.rest").alias("rest")))


def plan(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, repetition_limit: float = REPETITION_LIMIT,
         budget: float | None = None, seed: int = SEED) -> DataFrame:
    """A row for each source: source, tokens, weight, epochs, full, cut_key, cut_tie.

    A document is copied ``full`` times, and once more if its key in the epoch
    ``full`` comes before the cut.  ``docs`` is the result of ``sized``.
    """
    sources = staged(docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    a, tokens = exponent(sources, target_entropy, repetition_limit, budget)
    quota = quotas(sources, a, tokens)
    part = quota.filter("rest > 0").select("source", "full", "rest")
    keyed = docs.join(part, "source").withColumn("key", _key(F.col("full"), seed))
    keyed = keyed.select("source", "key", "tie", "n_tokens", "rest",
                         F.shiftright("key", 63 - _DIGIT).alias("d1"),
                         F.shiftright("key", 63 - 2 * _DIGIT).bitwiseAND(F.lit((1 << _DIGIT) - 1)).alias("d2"))
    keyed = staged(keyed, "mix-keys")
    first = _end(keyed, ["source"], "d1", "rest")
    inside = keyed.drop("rest").join(first, ["source", "d1"])
    second = staged(_end(inside, ["source", "d1"], "d2", "rest"), "mix-ends")
    last = keyed.drop("rest").join(second, ["source", "d1", "d2"])
    w = Window.partitionBy("source").orderBy("key", "tie").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = (last.withColumn("upto", F.sum("n_tokens").over(w)).filter(F.col("upto") <= F.col("rest"))
             .groupBy("source").agg(F.max(F.struct("key", "tie")).alias("m")))
    start = F.shiftleft(F.shiftleft("d1", _DIGIT) + F.col("d2"), 63 - 2 * _DIGIT)
    cut = second.join(taken, "source", "left").select(
        "source", F.coalesce("m.key", start).alias("cut_key"), F.coalesce("m.tie", F.lit(-(1 << 63))).alias("cut_tie"))
    return (quota.join(cut, "source", "left")
            .select("source", "tokens", "weight", "epochs", "full",
                    F.coalesce("cut_key", F.lit(-1).cast("long")).alias("cut_key"),
                    F.coalesce("cut_tie", F.lit(-(1 << 63))).alias("cut_tie")))


def copies(docs: DataFrame, mix: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` (with ``source`` and ``tie``) with a row for each copy and its ``epoch``."""
    small = mix.select("source", F.struct("full", "cut_key", "cut_tie").alias("_mix"))
    key = _key(F.col("_mix.full"), seed)
    more = (key < F.col("_mix.cut_key")) | ((key == F.col("_mix.cut_key")) & (F.col("tie") <= F.col("_mix.cut_tie")))
    out = docs.join(small, "source").withColumn("_n", F.col("_mix.full") + F.when(more, 1).otherwise(0)).filter("_n > 0")
    return out.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n", "_mix")


def blocks(copied: DataFrame, total_tokens: float, block_tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """Deal copies to output blocks and order them: block, place (from 1)."""
    n = max(1, round(total_tokens / (block_tokens or BLOCK_TOKENS)))
    dealt = F.xxhash64(F.lit(seed + 1), "epoch", "doc_id", "tie")
    w = Window.partitionBy("block").orderBy("deal", "doc_id", "epoch")
    return (copied.withColumn("deal", dealt).withColumn("block", F.pmod("deal", F.lit(n)).cast("long"))
            .withColumn("place", F.row_number().over(w)).drop("deal"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, source, n_tokens, epoch, block, place): the whole mix."""
    small = staged(sized(docs), "mix-sized")
    mix = staged(plan(small, **how), "mix-plan")
    total = mix.agg(F.sum(F.col("tokens") * F.col("epochs")).alias("t")).first()["t"] or 0.0
    return blocks(copies(small, mix), total).drop("tie")


def repeated(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with whole rows repeated or left out as the mix says."""
    small = staged(sized(docs), "mix-sized")
    mix = staged(plan(small, **how), "mix-plan")
    marked = docs.select("doc_id", _source(), _tie(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return copies(marked, mix).select("_row.*")
