"""Point-in-time join against brute force."""

import datetime as dt
import random

from riskview.operators.asof import as_of

DAY = dt.datetime(2024, 1, 1)


def brute(facts, versions):
    out = []
    for k, t, n in facts:
        own = [(s, v) for key, s, v in versions if key == k and k is not None and t is not None and s is not None and s <= t]
        out.append((k, t, n, *max(own, default=(None, None))))
    return sorted(out, key=repr)


def run(spark, facts, versions):
    f = spark.createDataFrame(facts, "customer_id long, at timestamp, n int")
    v = spark.createDataFrame(versions, "customer_id long, since timestamp, segment string")
    out = as_of(f, v, ["customer_id"], "at", "since")
    assert out.columns == ["customer_id", "at", "n", "since", "segment"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(1)
    when = lambda: DAY + dt.timedelta(hours=rng.randrange(24 * 400))
    versions = list({(k, s): (k, s, f"s{n}") for n in range(300) for k, s in [(rng.randrange(20), when())]}.values())
    facts = [(rng.randrange(24), when(), n) for n in range(500)]
    facts += [(k, s, 1000 + i) for i, (k, s, _) in enumerate(versions[:40])]  # at the very start of a version
    facts += [(None, DAY, 1), (3, None, 2), (99, DAY, 3)] * 2
    versions += [(None, DAY, "x"), (5, None, "y")]
    assert run(spark, facts, versions) == brute(facts, versions)


def test_empty_sides(spark):
    assert run(spark, [], [(1, DAY, "a")]) == []
    assert run(spark, [(1, DAY, 1)], []) == [(1, DAY, 1, None, None)]


def test_a_hot_key_is_spread_and_never_multiplied(spark):
    """One customer with most facts and versions: no operator puts out more
    rows than facts, versions and their months together."""
    versions = [(7, DAY + dt.timedelta(hours=7 * i), f"s{i}") for i in range(1000)]
    facts = [(7, DAY + dt.timedelta(minutes=97 * i), i) for i in range(4000)] + [(1, DAY, -1)]
    f = spark.createDataFrame(facts, "customer_id long, at timestamp, n int")
    v = spark.createDataFrame(versions, "customer_id long, since timestamp, segment string")
    out = as_of(f, v, ["customer_id"], "at", "since")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["n"]: r["segment"] for r in out.collect()}
    assert len(got) == len(facts) and got[-1] is None
    assert all(got[i] == f"s{min(97 * i // 420, 999)}" for i in range(4000))
