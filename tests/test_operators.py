"""Operators against brute force on small, awkward tables."""

import math
import random
import statistics
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseloom.functions import parsing as p
from caseloom.functions.lists import collect_lists, members
from caseloom.functions.ordering import sort_key
from caseloom.functions.skew import salted_join, spread_join, tune
from caseloom.operators import audit, authorization, canonical, coverage, history, lookup, pii, rules, runmetrics, standardize

DAY0 = date(2024, 1, 1)


def rows(df, *order):
    return sorted(tuple(r) for r in df.select(*order).collect())


# --- parsing -----------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-06-01", date(2026, 6, 1)),
        (" 06/01/2026 ", date(2026, 6, 1)),
        ("2026/06/01", date(2026, 6, 1)),
        ("01-06-2026", date(2026, 6, 1)),
        ("2026-02-30", None),
        ("01/19/82", None),
        ("1-2-2026", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    df = standardize.parse_dates(spark.createDataFrame([(text,)], "d string"), ["d"])
    assert df.first()["d_parsed"] == expected


def test_dates_under_other_formats(spark):
    df = spark.createDataFrame([("3 Feb 2024",), ("20240203",)], "d string")
    got = [r["d_parsed"] for r in standardize.parse_dates(df, ["d"], ["d MMM yyyy", "yyyyMMdd"]).collect()]
    assert got == [date(2024, 2, 3)] * 2


@pytest.mark.parametrize(
    "text, expected",
    [
        ("373.75", "373.75"),
        ("$ 1,373.75", "1373.75"),
        ("1,234,567", "1234567.00"),
        ("373,75", "373.75"),
        ("-20", "-20.00"),
        ("€5", "5.00"),
        ("1.234,56", None),
        ("2392.5O", None),
        ("12,3", None),
        ("", None),
        (None, None),
    ],
)
def test_amounts(spark, text, expected):
    df = standardize.parse_amounts(spark.createDataFrame([(text,)], "a string"), ["a"])
    value = df.first()["a_parsed"]
    assert (None if value is None else str(value)) == expected and df.columns == ["a", "a_parsed"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a, ; b", ["A", "B"]),
        ("x\r\ny|X", ["X", "Y"]),
        ("n/a", []),
        (" none ", []),
        ("", []),
        (None, []),
        ("NA|b", ["NA", "B"]),
    ],
)
def test_code_lists(spark, text, expected):
    df = standardize.parse_code_lists(spark.createDataFrame([(text,)], "c string"), ["c"])
    assert df.first()["c_array"] == expected


def test_enums_profile_and_digits(spark):
    df = spark.createDataFrame([(" usd", "1.5", "TRUE", "2024-01-02", "9-1 a"), ("x", "?", "?", "?", "a")],
                               "e string, n string, f string, d string, i string")
    got = standardize.standardize_enums(df, ["e"], ["n"], ["f"], ["d"]).transform(standardize.digits_only, ["i"]).collect()
    assert tuple(got[0])[:4] == ("USD", 1.5, True, date(2024, 1, 2)) and got[0]["i_normalized"] == "91"
    assert tuple(got[1])[:4] == ("X", None, None, None) and got[1]["i_normalized"] is None
    profile = standardize.profile_parses(df, ["d"], ["n"])
    assert rows(profile, "column_name", "outcome", "row_count", "parsed") == [
        ("d", "UNPARSED", 1, False),
        ("d", "yyyy-MM-dd", 1, True),
        ("n", "PLAIN", 1, True),
        ("n", "UNPARSED", 1, False),
    ]


def test_rules_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "")], "k int, v string")
    checked = rules.validate(df, [rules.Rule("BLANK", p.blank(F.col("v"))), rules.Rule("BIG", F.col("k") > 2)], valid_flag="ok")
    assert rows(checked.select("k", F.array_join("validation_errors", "|").alias("e"), "ok"), "k", "e", "ok") == [
        (1, "BLANK", False),
        (2, "", True),
        (3, "BLANK|BIG", False),
    ]
    assert rows(rules.code_counts(checked, "validation_errors"), "code", "row_count") == [("BIG", 1), ("BLANK", 2)]


def test_pii_masks_in_order_and_hashes_with_salt(spark):
    df = spark.createDataFrame([(1, "call 212-555-0199 or 123456789"), (2, None)], "k int, t string")
    found = pii.detect_pii(df, {}, {"SSN": ("t", pii.fv.SSN_PATTERN), "PHONE": ("t", pii.fv.PHONE_PATTERN)})
    out = pii.pii_hash(pii.redact(found, "t", "m"), ["k", "t"], salt="s").orderBy("k").collect()
    assert out[0]["m"] == "call [REDACTED_PHONE] or [REDACTED_SSN]" and out[0]["pii_types"] == ["SSN", "PHONE"]
    assert out[1]["m"] == "" and out[1]["pii_hash"] is None and len(out[0]["pii_hash"]) == 64
    assert pii.drop_sensitive(df, ["t"]).columns == ["k"]


# --- lists and canonical rows --------------------------------------------------------------------------
def test_lists_are_whole(spark):
    data = [("hot", f"v{i % 5000:04d}") for i in range(6000)] + [("warm", "a")] * 50
    data += [("cold", "b"), (None, "c"), ("none", None)]
    df = spark.createDataFrame(data, "k string, v string").withColumn("key", F.struct("k"))
    got = {r["key"]["k"]: r["vs"] for r in collect_lists(df, ["key"], {"vs": F.array("v")}).collect()}
    assert got == {"hot": [f"v{i:04d}" for i in range(5000)], "warm": ["a"], "cold": ["b"], None: ["c"]}
    assert members(df, ["key"], {"vs": F.array("v")}).where("key.k = 'hot'").count() == 5000
    summary = canonical.duplicate_summary(df.withColumn("s", F.lit(1.0)), ["k"], "s", id_col="v")
    by = {r["k"]: r for r in summary.collect()}
    assert by["hot"]["document_count"] == 6000 and by["hot"]["vs"] == got["hot"]
    assert by[None]["vs"] == ["c"] and by["none"]["vs"] == []


def test_averages_do_not_round_nor_overflow(spark):
    df = spark.createDataFrame([("a", 1e13), ("a", 1e-9), ("b", 0.1), ("b", 0.2)], "k string, s double")
    by = {r["k"]: r["avg_s"] for r in canonical.duplicate_summary(df, ["k"], "s").collect()}
    assert by == {"a": (1e13 + 1e-9) / 2, "b": 0.15}


def test_best_row_equals_a_sort(spark):
    rng = random.Random(5)
    data = [(rng.randrange(20), rng.choice([None, 1.5, 2.5]), rng.randrange(5), str(i)) for i in range(400)]
    df = spark.createDataFrame(data, "k int, a double, b int, c string")
    order = [("a", "desc"), ("b", "asc"), ("c", "asc")]
    best = {r["k"]: (r["a"], r["b"], r["c"]) for r in canonical.pick_best(df, ["k"], order).collect()}
    for k in range(20):
        mine = [r for r in data if r[0] == k]
        want = min(mine, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[3]))
        assert best[k] == want[1:]
    with pytest.raises(TypeError):
        sort_key(df, [("c", "desc")])


def test_reduce_and_lookup_keep_every_row(spark):
    dim = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 9)], "k string, v int")
    reduced = lookup.reduce_dimension(dim, ["k"], [("v", "asc")], "n")
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None), (5, None)], "i int, key string")
    got = lookup.lookup(left, reduced, {"key": "k"}, "n", "x")
    key = [(r["i"], r["v"], r["n"], r["x_exists"], r["x_ambiguous"]) for r in got.orderBy("i").collect()]
    assert key == [
        (1, 1, 2, True, True),
        (2, 3, 1, True, False),
        (3, None, 0, False, False),
        (4, None, 0, False, False),
        (5, None, 0, False, False),
    ]


def test_null_keys_are_dealt_out_and_heavy_keys_split(spark):
    """A third of the rows share one key, a third have none: no task may get more than a small part."""
    n = 60_000
    kind = F.col("id") % 3
    left = spark.range(n).select(
        "id",
        F.when(kind == 0, F.lit(7)).when(kind == 1, F.col("id")).cast("long").alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )
    right = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    saved = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in saved}
    try:
        for k, v in saved.items():
            spark.conf.set(k, v)
        tune(spark)
        joined = spread_join(left, right, ["k"])
        held = joined.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.max("pad"))
        sizes = [r["n"] for r in held.collect()]
        assert sum(sizes) == n and max(sizes) < n / 6
        checked = joined.agg(F.count_if(F.col("v") == F.col("k") * 2).alias("hit"), F.count("k").alias("known")).first()
        assert checked["hit"] == checked["known"] == 2 * n / 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "inner"])
def test_salted_join_equals_a_plain_join(spark, how):
    left = spark.range(3000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    per_key = spark.range(0, 50, 3).select(F.col("id").alias("k"))
    plain = rows(left.join(per_key, "k", how), "k", "v")
    assert rows(salted_join(left, per_key, ["k"], how, ["v"]), "k", "v") == plain


# --- history ----------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def claims_and_history(spark):
    rng = random.Random(11)

    def some(prefix, n):
        return [
            (
                f"{prefix}{i}",
                rng.choice(["m1", "m1", "m1", "m2", "m3", None]),
                DAY0 + timedelta(days=rng.randrange(900)) if rng.random() > 0.05 else None,
                Decimal(rng.randrange(100, 400)) if rng.random() > 0.05 else None,
            )
            for i in range(n)
        ]

    cur, past = some("c", 150), some("h", 400)
    # copies: many rows of one key, day and amount
    past += [(f"x{i}", "m1", DAY0 + timedelta(days=300), Decimal(200)) for i in range(120)]
    cur += [("x5", "m1", DAY0 + timedelta(days=301), Decimal(201))]
    schema = "id string, m string, day date, amt decimal(18,2)"
    return cur, past, spark.createDataFrame(cur, schema), spark.createDataFrame(past, schema)


def _prior(c, past, days=365):
    if c[1] is None or c[2] is None:
        return []
    return [h for h in past if h[1] == c[1] and h[2] and c[2] - timedelta(days=days) <= h[2] < c[2]]


def test_trailing_metrics(claims_and_history):
    cur, past, c, h = claims_and_history
    got = {r["id"]: r for r in history.trailing_metrics(c, h, ["m"], "day", "day", "amt").collect()}
    assert len(got) == len(cur)
    for row in cur:
        prior = _prior(row, past)
        amounts = [x[3] for x in prior if x[3] is not None]
        r = got[row[0]]
        assert (r["prior_count"], r["prior_amount"]) == (len(prior), sum(amounts))
        assert r["last_prior_date"] == max((x[2] for x in prior), default=None)
        assert r["mean_prior_amount"] == (pytest.approx(float(statistics.mean(amounts))) if amounts else None)


def test_recent_evidence(claims_and_history):
    cur, past, c, h = claims_and_history
    out = history.recent_evidence(c, h, ["m"], "day", "day", "id", ["amt"], out="e")
    got = {r["id"]: [x["id"] for x in r["e"]] for r in out.collect()}
    for row in cur:
        want = sorted(_prior(row, past), key=lambda x: (-x[2].toordinal(), x[0]))[:5]
        assert got[row[0]] == [x[0] for x in want]


def test_near_duplicates_count_distinct_ids(claims_and_history, spark):
    cur, past, _, _ = claims_and_history
    rng = random.Random(2)
    # ids with several days and amounts, ids that are null, and a current row without an id of its own
    past = past + [(h[0], h[1], h[2] and h[2] + timedelta(days=rng.randrange(40)), h[3] and h[3] + rng.randrange(9)) for h in past[:200]]
    past += [(None, *h[1:]) for h in past[:30]] + past[:20]
    cur = [(*c, c[0]) for c in cur] + [("c-none", "m1", DAY0 + timedelta(days=300), Decimal(200), None)]
    schema = "id string, m string, day date, amt decimal(18,2)"
    c, h = spark.createDataFrame(cur, f"{schema}, own string"), spark.createDataFrame(past, schema)
    ids = ("id", "day", "amt")
    got = {r["id"]: r["n"] for r in history.near_duplicate_counts(c, h, ["m"], ids, ids, out="n", own_id="own").collect()}
    want = {}
    for i, m, d, a, own in cur:
        if m is None or d is None or a is None:
            continue
        hits = {
            x[0]
            for x in past
            if x[1] == m and x[2] and x[3] is not None and x[0] is not None and x[0] != own
            and abs((x[2] - d).days) <= 30 and abs(x[3] - a) <= a * Decimal("0.05")
        }
        if hits:
            want[i] = len(hits)
    assert got == want and max(want.values()) > 100


def test_amounts_beyond_one_range(spark):
    """Bounds that lie ranges of cents apart, on both sides of the edges of a range."""
    edge = history.RANGE
    cents = [1, edge - 1, edge, edge + 1, 3 * edge - 1, 3 * edge, 40 * edge + 7]
    past = [(f"h{i}", "m", DAY0, Decimal(x) / 100) for i, x in enumerate(cents)]
    cur = [(f"c{i}", "m", DAY0, Decimal(x) / 100) for i, x in enumerate([edge, 3 * edge, 40 * edge, 5])]
    schema = "id string, m string, day date, amt decimal(18,2)"
    ids = ("id", "day", "amt")
    c, h = spark.createDataFrame(cur, schema), spark.createDataFrame(past, schema)
    for tolerance in ("0", "0.01", "0.7", "1"):
        got = {r["id"]: r["n"] for r in history.near_duplicate_counts(c, h, ["m"], ids, ids, out="n", tolerance=tolerance).collect()}
        want = {i: sum(abs(x[3] - a) <= a * Decimal(tolerance) for x in past) for i, _, _, a in cur}
        assert got == {i: n for i, n in want.items() if n}, tolerance


def test_a_heavy_key_is_dealt_out_by_amount(spark):
    """A key that holds a third of the rows: no window of the sweep sees more than a range of cents of it."""
    n = 30_000
    amount = (F.col("id") * 137 % 4_000_000 / 100).cast("decimal(18,2)")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    past = spark.range(n).select(F.col("id").cast("string").alias("id"), key.alias("m"), F.lit(DAY0).alias("day"), amount.alias("amt"))
    cur = past.where("m = 'hot' and id % 50 = 0")
    ids = ("id", "day", "amt")
    got = {r["id"]: r["n"] for r in history.near_duplicate_counts(cur, past, ["m"], ids, ids, out="n").collect()}
    hot = [Decimal(i * 137 % 4_000_000) / 100 for i in range(0, n, 3)]
    for r in cur.limit(40).collect():
        slack = r["amt"] * Decimal("0.05")
        assert got.get(r["id"], 0) == sum(abs(a - r["amt"]) <= slack for a in hot) - 1


def test_distinct_ids_over_days_and_keys(spark):
    rng = random.Random(8)
    past = [(rng.choice([None, *"abcdefgh"]), rng.choice(["k1", "k2", None]), DAY0 + timedelta(days=rng.randrange(900))) for _ in range(60)]
    past += [(f"s{i}", "k1", DAY0 + timedelta(days=rng.randrange(900))) for i in range(30) for _ in range(2)]
    asks = [(i, k, DAY0 + timedelta(days=i * 7)) for i in range(150) for k in ("k1", "k2", "k9")]
    h = spark.createDataFrame(past, "id string, k string, day date")
    c = spark.createDataFrame(asks, "i int, k string, day date")

    def seen(k, d):
        return {x[0] for x in past if x[0] and x[1] == k and d - timedelta(days=365) <= x[2] < d}

    per_key = {(r["i"], r["k"]): r["n"] for r in history.trailing_distinct(c, h, ["k"], "day", "day", "id", "n").collect()}
    assert per_key == {(i, k): len(seen(k, d)) for i, k, d in asks}
    over = {r["i"]: r["n"] for r in history.distinct_counts(c, h, ["k"], ("i", "day"), ("id", "day"), "n").collect()}
    want = {}
    for i, k, d in asks:
        want[i] = want.get(i, set()) | seen(k, d)
    assert {i: n for i, n in over.items() if n} == {i: len(s) for i, s in want.items() if s}


def test_distinct_ids_over_sets_of_keys(spark):
    """A key in a third of all lines beside many others, ids under many keys, repeated rows, null and empty sides."""
    rng = random.Random(11)
    names = ["hot", *(f"k{i}" for i in range(12))]
    past = []
    for _ in range(900):
        past.append((rng.choice([None, *range(40)]), rng.choice([None, "hot", "hot", *names]), DAY0 + timedelta(days=rng.randrange(800))))
    past += past[:60] + [(1, "hot", None)]
    asks = []
    for i in range(250):
        day = DAY0 + timedelta(days=rng.randrange(900))
        for k in {"hot", *rng.sample(names, rng.randrange(5))} if i % 3 else {rng.choice([*names, None])}:
            asks.append((i, k, day if i % 31 else None))
    h, c = spark.createDataFrame(past, "id int, k string, day date"), spark.createDataFrame(asks, "i int, k string, day date")
    names_ = (["k"], ("i", "day"), ("id", "day"), "n")
    want = {}
    for i, k, d in asks:
        seen = {x[0] for x in past if x[0] is not None and k and d and x[1] == k and x[2] and d - timedelta(days=365) <= x[2] < d}
        want[i] = want.get(i, set()) | seen
    got = {r["i"]: r["n"] for r in history.distinct_counts(c, h, *names_).collect()}
    assert got == {i: len(s) for i, s in want.items()} and max(got.values()) > 20
    assert {r["n"] for r in history.distinct_counts(c, h.where("false"), *names_).collect()} == {0}
    assert history.distinct_counts(c.where("false"), h, *names_).count() == 0


def test_sets_of_keys_never_list_the_ids_of_their_most_frequent_key(spark):
    """One key has 5,000 ids and is in 300 sets: what is listed grows with the other keys' ids alone."""
    hot = spark.range(5_000).selectExpr("named_struct('k', 'hot') AS _key", "id AS _other", "1 AS _day")
    rare = spark.range(600).selectExpr("named_struct('k', concat('k', id % 300)) AS _key", "id * 9 AS _other", "2 AS _day")
    sets = spark.range(300).selectExpr("id AS _set", "explode(array(named_struct('k', 'hot'), named_struct('k', concat('k', id)))) AS _key")
    over = history._overcounts(sets, spark.range(300).selectExpr("id AS _set", "3 AS _day"), hot.unionByName(rare), 365)
    assert {(r["_set"], r["_over"]) for r in over.collect()} == {(i, 2 if (i + 300) * 9 < 5_000 else 1) for i in range(300) if i * 9 < 5_000}

    def made(node):
        rows = [node.metrics().get("numOutputRows").get().value()] if node.metrics().contains("numOutputRows") else []
        plan = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in node.nodeName() else None
        below = [plan] if plan is not None else [node.children().apply(i) for i in range(node.children().size())]
        return max([*rows, *map(made, below)], default=0)

    over.collect()
    assert 5_000 <= made(over._jdf.queryExecution().executedPlan()) < 12_000  # 300 sets times 5,000 ids would be 1,500,000


def test_rows_with_nothing_but_themselves_near_leave_the_grid(spark):
    rows = [(str(i), f"m{i % 400}", DAY0 + timedelta(days=i % 400), Decimal(100 + 1000 * (i // 400))) for i in range(800)]
    rows += [("a", "m1", DAY0 + timedelta(days=2), Decimal(101)), ("b", "m9", DAY0 + timedelta(days=500), Decimal(100))]
    df = spark.createDataFrame(rows, "id string, m string, day date, amt decimal(18,2)")
    written = {}

    def count(part, name):
        written[name] = part.count()
        return part

    ids = ("id", "day", "amt")
    got = history.near_duplicate_counts(df, df, ["m"], ids, ids, out="n", between=count)
    assert {r["id"]: r["n"] for r in got.collect()} == {"1": 1, "a": 1}
    assert written["near_probes"] <= 4 and written["near_points"] <= 4


# --- authorization and coverage -----------------------------------------------------------------------------
def test_match_authorizations(spark):
    rng = random.Random(3)

    def day(spread=400):
        return DAY0 + timedelta(days=rng.randrange(spread)) if rng.random() > 0.1 else None

    grants = [
        (f"a{i:03d}", rng.choice(["APPROVED", "APPROVED", "DENIED", "PENDING", "CANCELLED"]), day(), day(), rng.choice(["k1", "k2", None]))
        for i in range(120)
    ]
    asks = [(i, rng.choice(["k1", "k2", "k3", None]), day()) for i in range(150)]
    g = spark.createDataFrame(grants, "authorization_id string, authorization_status string, valid_from date, valid_to date, k string")
    r = spark.createDataFrame(asks, "i int, k string, d date")
    got = {x["i"]: x for x in authorization.match_authorizations(r, g, ["k"], "d").collect()}
    for i, k, d in asks:
        mine = [x for x in grants if k is not None and x[4] == k]
        valid = {x[0] for x in mine if x[1] == "APPROVED" and d and x[2] and x[3] and x[2] <= d <= x[3]}
        best = min(
            mine,
            key=lambda x: (x[0] not in valid, x[3] is None, -(x[3] or DAY0).toordinal(), x[0]),
            default=(None,) * 5,
        )
        row = got[i]
        assert (row["authorization_match_count"], row["valid_authorization_count"]) == (len(mine), len(valid))
        assert row["authorization_id"] == best[0] and row["valid_to"] == best[3]


def test_priority_order(spark):
    data = [(1, s) for s in ("VALID", "CANCELLED", "EXPIRED")] + [(2, "VALID"), (2, "NOT_REQUIRED"), (3, None)]
    out = authorization.rollup_priority(spark.createDataFrame(data, "k int, s string"), ["k"], "s")
    assert rows(out, "k", "status")[:2] == [(1, "CANCELLED"), (2, "VALID")]


def test_lines_keep_records_without_codes(spark):
    df = spark.createDataFrame([(1, ["a", "b"], 10.0), (2, [], 10.0), (3, None, 5.0)], "k int, c array<string>, amt double")
    lines = coverage.allocate_evenly(coverage.explode_lines(df, "c"), "amt", "line_count", "share")
    assert [
        (r["k"], r["procedure_index"], r["procedure_code"], r["line_count"], r["share"]) for r in lines.orderBy("k", "procedure_index").collect()
    ] == [
        (1, 0, "a", 2, Decimal("5.0000")),
        (1, 1, "b", 2, Decimal("5.0000")),
        (2, None, None, 0, None),
        (3, None, None, 0, None),
    ]


# --- audits and run measures ----------------------------------------------------------------------------------
def test_audits_see_what_is_wrong(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert tuple(audit.audit_keys(a, b, ["k"]).first()) == (3, 3, 1, 1, 1)
    texts = spark.createDataFrame([("x 123-45-6789", ["123-45-6789"]), ("y", [])], "t string, l array<string>")
    assert rows(audit.audit_pattern_absent(texts, pii.fv.SSN_PATTERN), "column_name", "hits") == [("l", 1), ("t", 1)]
    fact = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "f string")
    dim = spark.createDataFrame([("a",), ("b",), ("b",), ("u",)], "d string")
    assert tuple(audit.reference_health(fact, dim, ("f", "d")).first()) == (5, 1, 1, 2, 1, 1, 1)


def test_counts_ride_on_the_write(spark):
    df = spark.range(10)
    watched, seen = audit.observe_counts(df, "r", even=F.col("id") % 2 == 0)
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}
    assert audit.audit_counts({"s": seen.get["rows"]}, {"s": 10, "t": 1}) == {"t": (None, 1)}


def test_exact_median_and_skew(spark):
    rng = random.Random(2)
    data = [("a", rng.random()) for _ in range(5001)] + [("b", 1.0), ("b", 4.0)] + [("c", None), ("d", -1.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r for r in runmetrics.skew_ratio(df, ["g"], "v").collect()}
    values = [v for g, v in data if g == "a"]
    assert got["a"]["median_value"] == statistics.median(values)
    assert got["a"]["skew_ratio"] == max(values) / statistics.median(values)
    assert got["b"]["median_value"] == 2.5 and got["d"]["skew_ratio"] is None and "c" not in got


def test_median_of_a_large_group(spark):
    df = spark.range(300_000).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % 300_007).cast("double").alias("v"))
    values = sorted((i * 7919) % 300_007 for i in range(300_000))
    got = runmetrics.exact_median(df, ["g"], "v").first()
    assert got["median_value"] == (values[149_999] + values[150_000]) / 2


def test_every_nested_leaf_is_redacted(spark):
    """Structs, lists of lists, maps with clashing keys, nulls at every depth, exempt paths, a column named like the counts."""
    schema = """id int, plain string, s struct<a:string,n:int,deep:struct<b:string>>, l array<array<string>>,
        ls array<struct<c:string,k:int>>, m map<string,array<string>>, mi map<int,string>, none string, redactions string"""
    ssn, phone = "123-45-6789", "(555) 201-4477"
    rows = [
        (1, f"x {ssn} {phone}", (ssn, 7, (phone,)), [[ssn, None], None, [f"{ssn} {ssn}"]], [(phone, 1), None, (None, 2)],
         {ssn: [ssn], "123-45-1111": [], "plain": [phone, None]}, {5: ssn, 6: None}, None, ssn),
        (2, None, None, None, None, None, None, None, None),
        (3, "", (None, None, None), [], [], {}, {}, "", ""),
        (3, "", (None, None, None), [], [], {}, {}, "", ""),
    ]
    df = spark.createDataFrame(rows, schema)
    out = pii.redact_leaves(df, exempt=["mi", "s.deep.b"])
    assert out.columns == df.columns
    assert [t for c, t in out.dtypes if c != "redactions"] == [t for c, t in df.dtypes if c != "redactions"]
    got = sorted(out.collect(), key=lambda r: r["id"])
    one, s_, p_ = got[0], "[REDACTED_SSN]", "[REDACTED_PHONE]"
    assert one["plain"].startswith(f"x {s_}") and "4477" not in one["plain"]
    assert one["s"].asDict(recursive=True) == {"a": s_, "n": 7, "deep": {"b": phone}}
    assert one["l"] == [[s_, None], None, [f"{s_} {s_}"]]
    assert "4477" not in str(one["ls"]) and one["ls"][1] is None and one["ls"][2]["c"] is None
    assert sorted(k.split(" #")[0] for k in one["m"]) == [s_, s_, "plain"]
    assert [s_] in one["m"].values() and [] in one["m"].values()
    assert "4477" not in str(one["m"]) and one["m"]["plain"][1] is None
    assert one["mi"] == {5: ssn, 6: None}
    assert one["redactions"] == {"plain": 2, "s.a": 1, "l": 3, "ls.c": 1, "m.key": 2, "m.value": 2}
    assert [tuple(r)[1:8] for r in got[1:]] == [tuple(r)[1:8] for r in df.where("id > 1").orderBy("id").collect()]
    assert all(r["redactions"] == {} for r in got[1:])
    left = audit.audit_leaves_absent(out.drop("mi", "redactions"), r"\d{3}-\d{2}-\d{4}").collect()
    assert left and all(r["hits"] == 0 for r in left)
    summary = {r["path"]: (r["row_count"], r["mask_count"]) for r in pii.redaction_summary(out).collect()}
    assert summary["l"] == (1, 3) and len(summary) == 6
    assert pii.redact_leaves(df.where("false")).count() == 0
    assert pii.redact_leaves(spark.range(1)).first().asDict() == {"id": 0, "redactions": {}}


def test_digits_order_like_the_values(spark):
    """Neighbours of powers of two, both signs, subnormal and infinite values, and the ends of the longs."""
    rng = random.Random(6)
    floats = [m * s for e in (-1074, -1073, -1030, -1022, -1021, -537, -1, 0, 1, 2, 52, 53, 1000, 1023) for m in (2.0**e,) for s in (1, -1)]
    floats += [math.nextafter(x, y) for x in floats for y in (0, math.copysign(math.inf, x))]
    floats += [0.0, math.inf, -math.inf, math.nan, 0.1, 0.3, *(rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(500))]
    longs = [0, 1, -1, 2**63 - 1, -(2**63), 65535, 65536, -65536, *(rng.randrange(-(2**62), 2**62) for _ in range(200))]
    for values, kind in ((floats, "double"), (longs, "long")):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}").distinct()
        digits = runmetrics._digits(F.col("v"), df.schema["v"].dataType)
        got = [(*r[1:], r[0]) for r in df.select("v", *[d.alias(f"d{i}") for i, d in enumerate(digits)]).collect()]
        by_digits = [r[-1] for r in sorted(got, key=lambda r: r[:4])]
        assert len({r[:4] for r in got}) == len(got)
        wanted = sorted(by_digits, key=lambda x: (x != x, x))
        assert list(map(repr, by_digits)) == list(map(repr, wanted))
        assert all(abs(r[0]) <= (2100 if kind == "double" else 2**15) and all(0 <= d < 2**18 for d in r[1:4]) for r in got)


@pytest.mark.parametrize("kind", ["double", "long", "int", "decimal(18,2)"])
def test_medians_equal_a_sorted_list(spark, kind):
    """Ties, repeated rows, null values, a null group, a group with a third of the rows, groups of one and two."""
    rng = random.Random(kind)
    number = {"double": lambda: rng.choice([rng.gauss(0, 1e6), 0.0, 1e-9, 7.25]), "decimal(18,2)": lambda: Decimal(rng.randrange(-9999, 9999)) / 100}
    draw = number.get(kind, lambda: rng.randrange(-80_000, 80_000))
    rows = [(rng.choice(["hot", "hot", *"abcdefgh", None]), rng.choice([draw(), draw(), draw(), None])) for _ in range(1500)]
    rows += rows[:100] + [("one", draw()), ("two", draw()), ("two", draw()), ("nothing", None)]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    got = {r["g"]: (r["value_count"], r["max_value"], float(r["median_value"])) for r in runmetrics.exact_median(df, ["g"], "v").collect()}
    assert got == {g: (len(x), max(x), pytest.approx(float(statistics.median(x)))) for g, x in want.items()}
    assert runmetrics.exact_median(df.where("false"), ["g"], "v").count() == 0


def test_latest_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w")], "k string, t int, v string")
    assert rows(runmetrics.latest_per_key(df, ["k"], "t", ["v"]), "k", "t", "v") == [("a", 3, "z"), ("b", 2, "w")]


def test_pattern_audit_reaches_every_leaf(spark):
    schema = "claim_id string, n int, e struct<ids:array<string>,past:array<struct<id:string,note:string,more:array<struct<t:string>>>>,m:map<string,string>>"
    dashed, bare = "x\n123-45-6789", "123456789"
    rows_ = [
        (bare, 1, ([bare, None], [(bare, "ok", None), None], {"k": dashed})),
        (dashed, 2, ([dashed], [(dashed, bare, [("no",)]), ("1", None, [(None,), (dashed,)])], None)),
        (None, 3, None),
    ]
    df = spark.createDataFrame(rows_, schema)
    ids = dict.fromkeys(["claim_id", "e.ids", "e.past.id"], r"\b\d{3}-\d{2}-\d{4}\b")
    got = rows(audit.audit_leaves_absent(df, pii.fv.SSN_PATTERN, ids), "column_name", "hits")
    assert sorted(got) == [("claim_id", 1), ("e.ids", 1), ("e.m.key", 0), ("e.m.value", 1), ("e.past.id", 1), ("e.past.more.t", 1), ("e.past.note", 1)]


def test_case_ssn_audit_leaves_out_no_text():
    from caseloom.catalog.claims import _CASE_TEXT, _EXEMPT
    from caseloom.catalog import load

    sql = load()["claim_ssn_leaves"].sql
    assert all(f"'{c}'" in sql or f"'{c}." in sql for c in [*_CASE_TEXT, *_EXEMPT])
