"""Adjusted prices: literal cases, then random tables with a hot symbol against brute force."""

import datetime as dt
import random

import pytest

from barloom import operators as ops
from barloom import schemas as S
from barloom.operators import adjust

DAY = dt.date(2024, 1, 1)

PLANS = {"steps": {"broadcast_bytes": adjust.BROADCAST_BYTES}, "days": {}}


def day(n):
    return DAY + dt.timedelta(days=n)


def prices_of(spark, rows):
    return spark.createDataFrame(rows, "SYMBOL string, SERIES string, DATE1 date, CLOSE_PRICE double")


def action(symbol, ex, kind, *numbers):
    dividend, bonus, split = 0.0, (0.0, 0.0), (1.0, 1.0)
    if kind == "dividend":
        dividend = float(numbers[0])
    elif kind == "bonus":
        bonus = tuple(map(float, numbers))
    elif kind == "split":
        split = tuple(map(float, numbers))
    return (symbol, ex, kind, dividend, *bonus, *split)


def adjusted(spark, prices, actions, **options):
    df = ops.adjusted_prices(prices_of(spark, prices), spark.createDataFrame(actions, S.ACTIONS), **options)
    return {(r.SYMBOL, r.SERIES, r.DATE1): r.ADJ_CLOSE_PRICE for r in df.collect()}


BARS = [("A", "EQ", day(n), 100.0) for n in range(4)]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize(
    ("act", "factor"),
    [
        (action("A", day(2), "dividend", 10), 0.9),
        (action("A", day(2), "dividend", 100), 1.0),
        (action("A", day(2), "dividend", 120), 1.0),
        (action("A", day(2), "bonus", 1, 1), 0.5),
        (action("A", day(2), "bonus", 2, 1), 1 / 3),
        (action("A", day(2), "bonus", 0, 0), 1.0),
        (action("A", day(2), "split", 1, 2), 2.0),
        (action("A", day(2), "split", 0, 2), 1.0),
        (action("A", day(2), "rights", 1, 2), 1.0),
        (action("A", day(0), "split", 1, 2), 1.0),
        (action("B", day(2), "split", 1, 2), 1.0),
        (action("a", day(2), "split", 1, 2), 1.0),
        (action("A", None, "split", 1, 2), 1.0),
    ],
)
def test_one_action(spark, plan, act, factor):
    found = adjusted(spark, BARS, [act], **PLANS[plan])
    assert [found["A", "EQ", day(n)] for n in range(4)] == pytest.approx(
        [100 * factor, 100 * factor, 100.0, 100.0]
    )


@pytest.mark.parametrize("plan", PLANS)
def test_same_day_actions_all_apply_unless_deduped(spark, plan):
    acts = [action("A", day(2), "dividend", 10), action("A", day(2), "dividend", 20)]
    assert adjusted(spark, BARS, acts, **PLANS[plan])["A", "EQ", day(0)] == pytest.approx(72.0)
    one = adjusted(spark, BARS, acts, dedupe_actions=True, **PLANS[plan])
    assert one["A", "EQ", day(0)] == pytest.approx(90.0)


@pytest.mark.parametrize("plan", PLANS)
def test_previous_close_is_raw_and_from_the_preferred_series(spark, plan):
    prices = [("A", "BE", day(0), 50.0), ("A", "EQ", day(0), 100.0), ("A", "N1", day(0), 10.0),
              ("A", "EQ", day(3), 80.0)]
    acts = [action("A", day(2), "dividend", 10), action("A", day(5), "split", 1, 2)]
    found = adjusted(spark, prices, acts, **PLANS[plan])
    assert found["A", "EQ", day(0)] == pytest.approx(100 * 0.9 * 2)
    assert found["A", "N1", day(0)] == pytest.approx(10 * 0.9 * 2)
    assert found["A", "EQ", day(3)] == pytest.approx(160.0)


@pytest.mark.parametrize("plan", PLANS)
def test_null_previous_close_leaves_prices(spark, plan):
    prices = [("A", "EQ", day(0), 100.0), ("A", "EQ", day(1), None), ("A", "EQ", day(2), 90.0)]
    found = adjusted(spark, prices, [action("A", day(2), "dividend", 10)], **PLANS[plan])
    assert found == {("A", "EQ", day(0)): 100.0, ("A", "EQ", day(1)): None, ("A", "EQ", day(2)): 90.0}


@pytest.mark.parametrize("plan", PLANS)
def test_without_actions(spark, plan):
    assert set(adjusted(spark, BARS, [], **PLANS[plan]).values()) == {100.0}


def brute_force(prices, actions):
    """One action at a time over all rows of its symbol."""
    priority = {"EQ": 0, "BE": 1}
    factors = {row[:3]: 1.0 for row in prices}
    for symbol, ex, kind, dividend, b_from, b_to, s_from, s_to in actions:
        before = [r for r in prices if r[0] == symbol and r[2] < ex]
        if not before:
            continue
        last = max(r[2] for r in before)
        close = min((r for r in before if r[2] == last), key=lambda r: (priority.get(r[1], 2), r[1]))[3]
        m = 1.0
        if kind == "dividend" and close is not None and close > 0 and dividend > 0:
            m = (close - dividend) / close
        elif kind == "split" and s_from > 0:
            m = s_to / s_from
        elif kind == "bonus" and b_from + b_to > 0:
            m = b_to / (b_from + b_to)
        if m > 0:
            for r in before:
                factors[r[:3]] *= m
    return {r[:3]: None if r[3] is None else r[3] * factors[r[:3]] for r in prices}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("plan", [*PLANS, "wide"])
def test_random_tables_with_a_hot_symbol(spark, plan, seed, monkeypatch):
    if plan == "wide":
        monkeypatch.setattr(adjust, "BUCKET_BITS", [9])
    rng = random.Random(seed)
    # Days on both sides of the epoch, where bucket numbers change sign.
    base = dt.date(1969, 10, 1) if seed == 1 else DAY

    def day(n):
        return base + dt.timedelta(days=n)

    prices, actions = {}, []
    for _ in range(600):
        symbol = "HOT" if rng.random() < 0.5 else f"S{rng.randrange(8)}"
        key = (symbol, rng.choice(["EQ", "BE", "N1", "N2"]), day(rng.randrange(200)))
        prices[key] = (*key, None if rng.random() < 0.05 else round(rng.uniform(1, 200), 2))
    for _ in range(120):
        symbol = "HOT" if rng.random() < 0.5 else f"S{rng.randrange(10)}"
        kind = rng.choice(["dividend", "split", "bonus", "rights"])
        numbers = {"dividend": [rng.choice([0.5, 2, 50])]}.get(kind, [rng.randrange(4), rng.randrange(1, 4)])
        actions.append(action(symbol, day(rng.randrange(-5, 205)), kind, *numbers))
    rows = list(prices.values())
    found = adjusted(spark, rows, actions, **PLANS.get(plan, {}))
    expected = brute_force(rows, actions)
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == (None if value is None else pytest.approx(value, rel=1e-9)), key


def test_symbols_as_list_or_frame(spark):
    prices = [*BARS, ("B", "EQ", day(0), 1.0)]
    acts = [action("A", day(2), "split", 1, 2)]
    for symbols in (["A"], spark.createDataFrame([("A",)], "name string")):
        assert {k[0] for k in adjusted(spark, prices, acts, symbols=symbols)} == {"A"}


def test_adjusted_columns_follow_the_schema(spark):
    df = ops.adjusted_prices(spark.createDataFrame([], S.PRICES), spark.createDataFrame([], S.ACTIONS))
    assert df.columns == S.ADJ_PRICES.fieldNames()


def test_impact(spark):
    df = spark.createDataFrame([(100.0, 50.0), (100.0, 100.0), (None, None), (0.0, 0.0)],
                               "CLOSE_PRICE double, ADJ_CLOSE_PRICE double")
    assert tuple(ops.adjustment_impact(df).first()) == (-50.0, 1)


@pytest.mark.parametrize(("rows", "bits"), [(35, 5), (34, 7), (11, 7), (10, 9), (5, 9), (4, None)])
def test_bucket_choice_is_a_bound(spark, rows, bits):
    events = spark.createDataFrame([("A", day(0)), ("A", day(1000))], "symbol string, ex_date date")
    width = 1 + 64 + 8 * 5
    assert adjust.choose_bucket_bits(events, rows * width) == bits


def test_no_events_are_small(spark):
    events = spark.createDataFrame([], "symbol string, ex_date date")
    assert adjust.choose_bucket_bits(events, 0) == 5
