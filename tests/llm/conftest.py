from pyspark.sql import types as T

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def doc_frame(spark, rows, schema=DOC_SCHEMA):
    """Documents from (doc_id, text[, lang, source]) tuples; n_chars is filled in."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])))
    return spark.createDataFrame(full, schema)


def components(ids, linked):
    """Smallest id reachable, by brute force over ``linked(i, j)``."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(ids)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


__all__ = ["T", "doc_frame", "components"]
