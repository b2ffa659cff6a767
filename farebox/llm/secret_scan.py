"""Operator 9: secret scans with character Markov models, in native expressions.

Three base patterns (assignments, access ids, hex runs) give spans that always
stand.  Beside them, runs of 20 or more token characters outside the base spans are compared
under two character bigram models, one of random strings and one of ordinary identifiers.
A run is cut at ``/``; parts whose log-likelihood ratio per character exceeds ``MIN_RATIO``
are random, and neighbouring random parts of 20 characters or more together are a further
span of kind ``random``.  ``=`` ends a run, so a name or a path before a key does not hide it.

Both models are trained from labelled samples.  Random strings (label 1) are
base64, base36-like and hex renderings of hashes; identifiers (label 0) are the words of
``SAMPLE_DOCS`` documents, those with the smallest hash of their id.  Both bounds
are parameters.  A model has 128 x 128 transitions whatever the corpus, so the
ratios travel as one array from a scalar subquery.  No Python runs on executors.

Defined cases: a null text is empty and has no spans; equal rows give equal rows; very
long texts are scanned whole, in time that follows their length for long runs and for many
matches (places are summed in chunks of ``CHUNK`` matches); ``scan`` replaces columns named
``base`` or ``spans`` and passes all others through;
an empty table gives an empty result (the models then know random strings only
and are not used); spans are in code points, end exclusive, ordered by start and
then by kind as listed in ``KINDS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.llm.common import text_or_empty

# Base patterns and the least length of what counts, by contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
MIN_ASSIGN, MIN_ACCESS = 6, 20

#: Kinds of span, in the order in which ties of a start are listed.
KINDS = ["assign", "access", "hex", "random"]

#: Runs that the models compare: no base match starts within one.  The last group of the
#: pattern is the run; matches without it are base matches, which are passed over.
MIN_RUN = 20
_BASE = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
         r"|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}")
RUN = rf"(?:{_BASE})|((?:(?!{_BASE})[A-Za-z0-9+/_-]){{{MIN_RUN},}}+)"
MAY_RUN = rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}"

#: Matches whose places are summed in one fold.
CHUNK = 128

#: Bounds of the labelled samples: random strings, and documents for identifiers.
SAMPLE_STRINGS, SAMPLE_DOCS = 20_000, 2_000

#: Least log-likelihood ratio a character (nats) of a random span.
MIN_RATIO = 0.75

#: Weight, in counts, of the second character's own share.
SMOOTHING = 8.0

_SPANS = "array<struct<start:int,end:int,match:string,value:string>>"


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is worked out once, also where ``use`` has loops."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def occurrences(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, end, match, value of a group).

    A split at the pattern gives what stands between the matches, so the running
    sum of lengths gives their places; it is taken in chunks, so that no array is
    copied once for each match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def zipped(w: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(w))
        return F.arrays_zip(between.alias("gap"), w.alias("match"), value.alias("value"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def size_of(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["match"]))

    def placed(parts: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int")),
                             lambda c: F.slice(parts, c * CHUNK + 1, F.lit(CHUNK)))

        def with_bases(chunk: Column) -> Column:
            def of(sizes: Column) -> Column:
                def one(part: Column, i: Column) -> Column:
                    base = F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda n, x: n + x)
                    start = F.struct(base.alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("out"))
                    return F.aggregate(part, start, add, lambda acc: acc["out"])

                return F.flatten(F.transform(chunk, one))

            return let(F.transform(chunk, size_of), of)

        return F.when(F.size(parts) > 0, let(chunks, with_bases)).otherwise(F.expr(f"cast(array() as {_SPANS})"))

    return let(let(whole, zipped), placed)


def _found(text: Column, kind: str, pattern: str, when: str, group: int = 0, least: int = 0) -> Column:
    """Spans of one kind; the extraction runs only where ``when`` matches."""
    got = F.filter(occurrences(text, pattern, group), lambda x: F.length(x["value"]) >= least)
    rank = KINDS.index(kind)
    got = F.transform(got, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), x["match"].alias("match")))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,match:string>>)")
    return F.when(F.regexp_like(text, F.lit(when)), got).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": _found(text, "assign", ASSIGN, ASSIGN, 2, MIN_ASSIGN),
        "access": _found(text, "access", ACCESS, ACCESS, 0, MIN_ACCESS),
        "hex": _found(text, "hex", HEX, HEX),
    }


def labelled_samples(spark: SparkSession, docs: DataFrame, strings: int = SAMPLE_STRINGS,
                     sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Training strings (sample, label): 1 random, 0 ordinary."""
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    shape = F.col("id") % 3
    random = spark.range(strings).select(
        F.when(shape == 0, F.substring(F.base64(F.unhex(digest)), 1, 40))
        .when(shape == 1, F.substring(F.upper(F.base64(F.unhex(digest))), 1, 40))
        .otherwise(F.substring(digest, 1, 40)).alias("sample"), F.lit(1).alias("label"))
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct()
    ordinary = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(
        F.explode(F.regexp_extract_all(text_or_empty(), F.lit("[A-Za-z_-]{4,}"), F.lit(0))).alias("sample"),
        F.lit(0).alias("label"))
    return random.unionByName(ordinary)


def train(samples: DataFrame) -> DataFrame:
    """Log-likelihood ratio of each of the 128 x 128 transitions: (idx, ratio).

    Transitions are smoothed towards the share of the second character alone, and
    that by half a count for each of 64 characters.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("sample") - 1)).alias("at")
    pairs = (samples.filter(F.length("sample") > 1).select("sample", "label", at)
             .select("label", F.ascii(F.expr("substring(sample, at, 1)")).alias("a"),
                     F.ascii(F.expr("substring(sample, at + 1, 1)")).alias("b")))
    counts = pairs.groupBy("label", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    seen = counts.groupBy("a", "b").agg(*[
        F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)])
    grid = (samples.sparkSession.range(128 * 128)
            .select(F.col("id").alias("idx"), F.expr("int(id div 128)").alias("a"), F.expr("int(id % 128)").alias("b")))
    first, second, all_ = (Window.partitionBy(*by) for by in (["a"], ["b"], [F.lit(0)]))

    def share(k: int) -> Column:
        n = F.coalesce(f"n{k}", F.lit(0))
        alone = (F.sum(n).over(second) + 0.5) / (F.sum(n).over(all_) + 32.0)
        return F.log((n + SMOOTHING * alone) / (F.sum(n).over(first) + SMOOTHING))

    return grid.join(seen, ["a", "b"], "left").select("idx", (share(1) - share(0)).alias("ratio"))


def ratios(model: DataFrame) -> Column:
    """The model as one array, by a scalar subquery (16,384 numbers at any scale)."""
    return model.agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "ratio"))), lambda x: x["ratio"])
                     .alias("ratios")).scalar()


def ratio_of(token: Column, model: Column) -> Column:
    """Mean log-likelihood ratio of the transitions of a string of two characters or more."""
    def of(codes: Column) -> Column:
        n = F.size(codes) - 1
        each = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: F.get(model, a * 128 + b))
        return F.aggregate(each, F.lit(0.0), lambda total, x: total + x) / n

    return let(F.transform(F.split(token, ""), lambda c: F.ascii(c)), of)


_RANDOM = "array<struct<start:int,rank:int,end:int>>"


def random_parts(start: Column, run: Column, model: Column, min_ratio: float) -> Column:
    """Spans (start, rank, end) of a run's neighbouring random parts of ``MIN_RUN``
    characters or more together."""
    rank = F.lit(KINDS.index("random"))

    def closed(acc: Column) -> Column:
        span = F.struct(acc["lo"].alias("start"), rank.alias("rank"), acc["hi"].alias("end"))
        return F.when(acc["hi"] - acc["lo"] >= MIN_RUN, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])

    def step(acc: Column, part: Column) -> Column:
        n = F.length(part)
        hot = F.when(n >= 2, ratio_of(part, model) >= min_ratio).otherwise(False)
        end = acc["at"] + n
        return let(hot, lambda h: F.struct(
            (end + 1).alias("at"), F.when(h, F.coalesce(acc["lo"], acc["at"])).alias("lo"), F.when(h, end).alias("hi"),
            F.when(h, acc["out"]).otherwise(closed(acc)).alias("out")))

    none = F.lit(None).cast("int")
    empty = F.struct(start.alias("at"), none.alias("lo"), none.alias("hi"), F.expr(f"cast(array() as {_RANDOM})").alias("out"))
    return F.aggregate(F.split(run, "/"), empty, step, closed)


def scan(docs: DataFrame, min_ratio: float = MIN_RATIO, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, rank, end, match),
    base spans and all spans, each ordered by start and kind."""
    spark = docs.sparkSession
    model = ratios(train(labelled_samples(spark, docs.select("doc_id", F.col(text).alias("text")))))
    whole = docs.withColumn("_whole", text_or_empty(text))
    found = base_spans(F.col("_whole"))
    out = whole.withColumn("base", F.array_sort(F.concat(*found.values())))
    runs = F.filter(occurrences(F.col("_whole"), RUN, 1), lambda r: r["value"] != "")
    out = out.withColumn("_runs", F.when(F.regexp_like("_whole", F.lit(MAY_RUN)), runs))
    out = out.withColumn("_model", F.when(F.size("_runs") > 0, model))
    added = F.flatten(F.transform("_runs", lambda r: F.transform(
        random_parts(r["start"], r["value"], F.col("_model"), min_ratio),
        lambda s: F.struct(s["start"], s["rank"], s["end"], F.substring(r["value"], s["start"] - r["start"] + 1, s["end"] - s["start"])
                           .alias("match")))))
    out = out.withColumn("spans", F.when(F.size("_runs") > 0, F.array_sort(F.concat("base", added))).otherwise(F.col("base")))
    return out.drop("_whole", "_runs", "_model")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, overlapping ones as one, replaced by ``mark``."""
    whole = text_or_empty(text)

    def cut(acc: Column, s: Column) -> Column:
        gap = F.substring(whole, acc["at"] + 1, s["start"] - acc["at"])
        more = F.concat(acc["out"], F.array(gap, F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    done = F.aggregate(spans, empty, cut, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(whole, acc["at"] + 1, F.length(whole))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
