"""Small documents that hold the cases every operator must define: null, empty, blank, long, repeated."""

import random


def documents(spark, texts, **more):
    """documents rows for ``texts`` (or (doc_id, text) pairs), with extra columns whose names may clash."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    data = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, schema)
    for name, value in more.items():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(value))
    return df


def scribble(seed, n, alphabet):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


def write_table(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
