"""Small tables with the awkward rows that every operator must stand."""

import random

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and to in that is was for on with as his they at be this from have or by one had not but what "
         "all were when we there can an your which their said if do will each about how up out them then she").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "."]) for _ in range(n))


def rows(n=40, seed=3):
    """Ordinary documents, then nulls, empties, repeats, white space and a very long text."""
    rng = random.Random(seed)
    out = [(i, sentence(rng, rng.randint(1, 120)), "en", f"src{i % 3}") for i in range(n)]
    out += [(n, None, None, None), (n + 1, "", "en", ""), (n + 2, " \t\n ", "en", "src0"), (n + 3, out[0][1], "en", "src1"),
            (n + 4, "Ünïcode — “quotes” 日本語 don't stop <|endoftext|> x", "de", "src2"),
            (n + 5, sentence(rng, 6000), "en", "src0"), (n + 5, sentence(rng, 5), "en", "src0"),
            (None, "no id at all", "en", "src1")]
    return [(*r, len(r[1] or "")) for r in out]


def frame(spark, data=None):
    """Documents with two extra columns, one of which clashes with inner names."""
    schema = T.StructType.fromDDL(DOCS + ", key string, score string")
    return spark.createDataFrame([(*r, "k", "s") for r in (rows() if data is None else data)], schema)


def save(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
