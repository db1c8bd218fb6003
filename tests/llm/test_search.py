"""Exact search against brute force, and the registered queries against their SQL."""

import math

import numpy as np
import pytest
from oracle import connect, difference

from hearth.llm import queries, topk

SF = "/root/testdata/sf0.001"


def brute(rows, top, every, scale=1024):
    vectors = {}
    for vec_id, x in rows:
        if vec_id is not None and x is not None and all(v is not None and math.isfinite(v) and abs(v * scale) < math.sqrt(2**62 / len(x)) for v in x):
            vectors.setdefault((vec_id, tuple(math.floor(scale * float(v)) for v in x)), None)
    out = []
    for q, a in vectors:
        if q % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors if c != q and len(a) == len(b)]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("top, bits, block, chunk", [(10, 6, 512, 1 << 15), (3, 1, 2, 40), (40, 8, 3, 7)])
def test_search(spark, monkeypatch, top, bits, block, chunk):
    monkeypatch.setattr(topk, "BLOCKS", 4)
    rng = np.random.default_rng(top)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in rng.permutation(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(60)]  # one very common vector
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(2010, []), (2011, []), (2020, [1.0, 2.0]), (2030, [1.0, -2.0]), (2040, [1e5] * 8), (2050, [1e300] + [0.0] * 7), (2060, [-1e300, 1e18]), (10, rows[0][1]), rows[5]]
    df = spark.createDataFrame([(i, x, 1, "k") for i, x in rows], "vec_id bigint, embedding array<double>, rank int, key string")
    found = sorted(tuple(r) for r in topk.search(df, top=top, every=10, bits=bits, block=block, chunk=chunk).collect())
    assert found == brute(rows, top, 10)


def test_work_is_laid_out_the_same_for_any_number_of_queries(spark, monkeypatch):
    """Neither jobs nor plans grow with the queries: they are rows of one job."""
    written, write = [], topk.stage

    def spied(df, label):
        written[-1].append((label, df._jdf.queryExecution().optimizedPlan().toString().count("\n")))
        return write(df, label)

    monkeypatch.setattr(topk, "stage", spied)
    df = spark.createDataFrame([(i, [float(i % 17), float(i % 5)]) for i in range(300)], "vec_id bigint, embedding array<double>")
    for every in (100, 1):
        written.append([])
        topk.search(df, every=every, block=2, chunk=16).count()
    assert written[0] == written[1]


def test_search_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert topk.search(df.limit(0)).count() == 0
    assert topk.search(df).count() == 0  # no query
    assert topk.search(spark.createDataFrame([(100, [1.0])], df.schema)).count() == 0  # no candidate


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None
