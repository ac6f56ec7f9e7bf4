"""Bitmaps of ids against sets."""

import random

from pyspark.sql import functions as F

from caseloom.operators import idsets


def test_codes_are_dense_and_the_same_for_the_same_ids(spark):
    ids = [f"id {i}" for i in range(500)] + [None, "id 3", ""]
    df = spark.createDataFrame([(i, 1) for i in ids], "who string, code int")
    got = {r["id"]: r["code"] for r in idsets.id_codes(df, "who", parts=7).collect()}
    assert sorted(got.values()) == list(range(501)) and set(got) == set(ids) - {None}
    again = {r["id"]: r["code"] for r in idsets.id_codes(df.repartition(5).unionByName(df), "who", parts=7).collect()}
    assert again == got
    assert idsets.id_codes(df.where("false"), "who").count() == 0


def test_bitmaps_equal_sets(spark):
    """Null keys and codes, repeated rows, a key with a third of the rows, codes on both sides of a range's end."""
    rng = random.Random(2)
    edge = idsets.WIDTH
    draw = lambda: rng.choice([0, 1, 7, 8, edge - 1, edge, edge + 1, 5 * edge, rng.randrange(10 * edge), None])
    tables = []
    for _ in range(2):
        rows = [(rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([1, 2]), draw()) for _ in range(900)]
        tables.append(rows + rows[:100])
    want = {}
    for k, n, c in tables[0] + tables[1]:
        if c is not None:
            want.setdefault((k, n), set()).add(c)
    dfs = [spark.createDataFrame(t, "k string, n int, code long").repartition(4) for t in tables]
    whole = idsets.union(*[idsets.id_bitmaps(d, ["k", "n"], "code") for d in dfs], keys=["k", "n"])
    assert {(r["k"], r["n"]): r["n_ids"] for r in idsets.counts(whole, ["k", "n"]).collect()} == {k: len(v) for k, v in want.items()}
    got = {}
    for r in idsets.members(whole, ["k", "n"]).collect():
        got.setdefault((r["k"], r["n"]), []).append(r["code"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    fewer = idsets.union(whole, keys=["n"])
    assert {r["n"]: r["n_ids"] for r in idsets.counts(fewer, ["n"]).collect()} == {n: len(set().union(*[v for k, v in want.items() if k[1] == n])) for n in (1, 2)}
    assert idsets.members(idsets.id_bitmaps(dfs[0].where("false"), ["k"], "code"), ["k"]).count() == 0


def test_a_heavy_key_is_rows_of_fixed_size(spark):
    df = spark.range(200_000).select(F.lit("hot").alias("k"), "id")
    maps = idsets.id_bitmaps(df.unionByName(df), ["k"], "id")
    assert maps.count() == -(-200_000 // idsets.WIDTH) and maps.agg(F.max(F.length("ids"))).first()[0] <= 4096
    assert idsets.counts(maps, ["k"]).first()["n_ids"] == 200_000
