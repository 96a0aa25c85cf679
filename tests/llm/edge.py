"""Documents with every awkward case, and a DuckDB connection over a data folder."""

import os
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside
    *[T.StructField(c, T.StringType()) for c in
      ("row", "id", "sha", "size", "score", "kept", "node", "key", "text_sha256", "target", "found", "block", "spans")],
])


def edge_texts() -> list[tuple]:
    r = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "naïve", "Straße", "日本語", "x1", "the", "of"]
    long = " ".join(r.choice(words) + str(r.randrange(500)) for _ in range(30000))
    base = " ".join(r.choice(words) + str(r.randrange(500)) for _ in range(300))
    near = base.replace("alpha", "omega", 3)
    return [
        (1, base, "en", "a", None), (2, base, "en", "b", None), (2, base, "en", "b", None), (9, near, "en", None, 3),
        (None, "a null id", "en", "a", 1), (None, "a null id", "en", "a", 1), (3, None, None, None, None),
        (4, "", "en", "a", 0), (5, "   \n\t ", "en", "c", 6), (6, long, "en", "c", len(long)), (7, "\x00\x1f  　 x", "en", "ä", 0),
        (8, "one", "en", "Z", 3), (10, "password = 'hunter2hunter2' AKIA" + "A1" * 8 + " " + "0a" * 20, "en", "a", 0),
        (-50, "<|endoftext|> 's can't <|endoftext|>\n\n  end ", "en", "b", 0),
    ]


def edge_docs(spark):
    extra = ("x",) * (len(SCHEMA) - 5)
    return spark.createDataFrame([(*t, *extra) for t in edge_texts()], SCHEMA).repartition(3)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con
