"""Mergeable distinct counts, period joins and several distinct counts at once, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kpiloom import operators as ops, plans
from kpiloom.functions.dates import month_start
from kpiloom.session import materialise

DAY0 = dt.date(2024, 11, 3)


def sales(seed, n, days=150, people=90):
    rng = random.Random(seed)
    return [(DAY0 + dt.timedelta(rng.randrange(days)), rng.choice("ABC"), rng.choice([None, *(f"u{k}" for k in range(people))]))
            for _ in range(n)]


def distinct(rows, key):
    out = {}
    for day, store, person in rows:
        if person is not None:
            for k in key(day, store):
                out.setdefault(k, set()).add(person)
    return sorted((*k, len(v)) for k, v in out.items())


@pytest.fixture
def states(spark, tmp_path):
    def build(rows, numbers=None):
        df = spark.createDataFrame(rows, "day date, store string, person string")
        numbers = ops.number_ids(df, "person", numbers)
        return plans.people_states(df, numbers, "person", keys=["store"]), numbers
    return build


def test_counts_of_any_period_come_from_daily_states(states, rows, tmp_path):
    data = sales(1, 900)
    stored = materialise(states(data)[0], f"{tmp_path}/states")
    month = lambda d: d.replace(day=1)
    assert rows(plans.people_per_period(stored, "month", keys=["store"])) == distinct(data, lambda d, s: [(month(d), s)])
    assert rows(plans.people_per_period(stored, "month")) == distinct(data, lambda d, s: [(month(d),)])
    assert rows(plans.people_per_period(stored, "day")) == distinct(data, lambda d, s: [(d,)])
    months = sorted({month(d) for d, _, p in data if p})
    own = dict(distinct(data, lambda d, s: [(month(d),)]))
    ytd = distinct(data, lambda d, s: [(m,) for m in months if m.year == d.year and m >= month(d)])
    assert rows(plans.buyers_ytd_exact(stored)) == [(m, own[m], n) for m, n in ytd]
    last = max(d for d, _, p in data if p)
    got = rows(plans.rolling_people(stored, ops.rolling_anchor(stored, "day", "2030-01-01"), 28, 9, "P"))
    want = dict(distinct(data, lambda d, s: [((last - d).days // 28,)]))
    assert [(b, n) for b, _, _, _, n in got] == [(b, want.get(b, 0)) for b in range(9)]
    weeks = ops.unite_states(stored, {"week": F.date_trunc("week", "day").cast("date")})
    monday = lambda d: d - dt.timedelta(d.weekday())
    all_weeks = {monday(d) for d, _, p in data if p}
    assert rows(ops.trailing_counts(weeks, "week", 28, "n")) == distinct(
        data, lambda d, s: [(w,) for w in all_weeks if 0 <= (w - monday(d)).days < 28])


def test_later_days_join_stored_states(spark, states, rows, tmp_path):
    first, later = sales(2, 300), [(d + dt.timedelta(90), s, p and p.replace("u", "v" if k % 2 else "u"))
                                   for k, (d, s, p) in enumerate(sales(3, 300))]
    old, numbers = states(first)
    old, numbers = materialise(old, f"{tmp_path}/old"), materialise(numbers, f"{tmp_path}/numbers")
    new, more = states(later, numbers)
    known = {r.id: r.number for r in numbers.collect()}
    now = {r.id: r.number for r in more.collect()}
    assert now.items() >= known.items() and sorted(now.values()) == list(range(1, len(now) + 1))
    both = old.unionByName(new)
    assert rows(plans.people_per_period(both, "month")) == distinct(first + later, lambda d, s: [(d.replace(day=1),)])


def test_numbers_are_dense_and_do_not_depend_on_partitions(spark):
    ids = [(f"k{k}",) for k in range(5000)] * 2 + [(None,)]
    df = spark.createDataFrame(ids, "id string")
    one, other = ({r.id: r.number for r in ops.number_ids(df.repartition(n), "id", parts=7).collect()} for n in (1, 6))
    assert one == other and sorted(one.values()) == list(range(1, 5001))


def test_states_of_many_numbers_take_many_rows(spark, rows):
    df = spark.range(100_000).select(F.lit(1).alias("g"), "id")
    states = ops.distinct_states(df, {"g": F.col("g")}, ops.number_ids(df, "id"), "id")
    assert states.count() == 4 and rows(ops.count_states(states, {}, "n")) == [(100_000,)]


def test_sketches_stay_within_their_stated_error(spark):
    df = spark.range(60_000).select(F.date_add(F.lit(DAY0), (F.col("id") % 90).cast("int")).alias("day"),
                                    (F.xxhash64("id") % 20_000).alias("person"))
    states = ops.sketch_states(df, {"day": F.col("day")}, "person")
    got = {r.Mes: r.n for r in ops.count_sketches(states, {"Mes": month_start(F.col("day"))}, "n").collect()}
    want = {r.Mes: r.n for r in df.groupBy(month_start(F.col("day")).alias("Mes")).agg(F.countDistinct("person").alias("n")).collect()}
    error = 1.04 / 2 ** 6
    assert got.keys() == want.keys() and all(abs(got[m] / want[m] - 1) < 4 * error for m in want)


def test_empty_states(spark, states, rows):
    empty, _ = states([])
    assert rows(plans.people_per_period(empty, "month")) == [] and rows(plans.buyers_ytd_exact(empty)) == []
    assert rows(plans.rolling_people(empty, ops.rolling_anchor(empty, "day", "2024-01-01"), 7, 2, "P")) == []


def test_periods_of_any_kind(spark, rows):
    rng = random.Random(4)
    days = [(DAY0 + dt.timedelta(rng.randrange(-400, 400)), k) for k in range(300)] + [(None, 300)]
    spans = [(DAY0 + dt.timedelta(a), DAY0 + dt.timedelta(a + rng.choice([0, 1, 6, 27, 40, 500, -3])), f"p{k}")
             for k, a in enumerate(rng.choices(range(-450, 450), k=40))] + [(None, DAY0, "open"), (DAY0, None, "open")]
    daily = spark.createDataFrame(days, "day date, n int")
    periods = spark.createDataFrame(spans, "start date, end date, name string")
    want = sorted((d, n, s, e, name) for d, n in days for s, e, name in spans if d and s and e and s <= d <= e)
    for bins in (1, 32, 1000):
        met = ops.period_membership(daily, "day", periods, bin_days=bins)
        assert rows(met) == want
    assert "NestedLoop" not in met._jdf.queryExecution().executedPlan().toString()
    late = daily.select(F.to_timestamp(F.concat(F.col("day").cast("string"), F.lit(" 23:30:00"))).alias("day"), "n")
    assert ops.period_membership(late, "day", periods).count() == len(want)
    sums = {(s, e, name): 0 for s, e, name in spans}
    for _, n, s, e, name in want:
        sums[s, e, name] += n
    assert {tuple(r[:3]): r[3] for r in ops.period_sums(daily, "day", periods, ["n"]).collect()} == sums


def test_several_distinct_counts_without_expand(spark, rows):
    data = [("a", 1, -0.0, b"x", None), ("a", 1, 0.0, b"y", [1]), ("a", 2, float("nan"), b"x", [1]), ("a", None, float("nan"), None, [None]),
            ("b", None, None, None, None), (None, 7, 1.5, b"", [])]
    df = spark.createDataFrame(data, "g string, i int, d double, r binary, l array<int>")
    got = ops.count_distinct(df, ["g"], {"i": "i", "d": "d", "r": "r", "l": "l"})
    assert rows(got) == [(None, 1, 1, 1, 1), ("a", 2, 2, 2, 2), ("b", 0, 0, 0, 0)]
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    total = ops.count_distinct_if(df, [], {"one": ("i", F.col("d") == 0), "none": ("i", F.lit(False)), "all": ("d", F.lit(True))})
    assert rows(total) == [(1, 0, 3)]
    assert rows(ops.count_distinct(df.limit(0), [], {"i": "i", "d": "d"})) == [(0, 0)]


def test_an_hour_that_repeats_keeps_its_instants_apart(spark, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        df = spark.createDataFrame([(1,)], "g int").select("g", F.explode(F.array(
            F.timestamp_seconds(F.lit(1729987200)), F.timestamp_seconds(F.lit(1729990800)))).alias("t"))
        assert rows(ops.count_distinct(df, ["g"], {"t": "t", "g2": "g"})) == [(1, 2, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
