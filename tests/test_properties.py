"""Property tests: random inputs, brute-force answers."""

import itertools
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopframe.functions.baskets import item_sets, pair_counts, patterns
from shopframe.functions.exprs import rnd
from shopframe.functions.prefix import row_numbers
from shopframe.operators import rules as r

ITEMS = list("abcdef")
baskets_st = st.lists(st.lists(st.sampled_from(ITEMS), min_size=1, max_size=5), min_size=1, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(baskets_st)
def test_pair_counts_match_brute_force(spark, baskets):
    rows = [(i, it) for i, b in enumerate(baskets) for it in b]
    df = spark.createDataFrame(rows, "o long, item string")
    got = {(x.a, x.b): x.n for x in pair_counts(patterns(item_sets(df, "o", "item", 2))).collect()}
    exp = {}
    for b in baskets:
        for a, c in itertools.combinations(sorted(set(b)), 2):
            exp[(a, c)] = exp.get((a, c), 0) + 1
    assert got == exp


@SETTINGS
@given(baskets_st, st.sampled_from([0.1, 0.2, 0.34]))
def test_itemsets_and_rules_match_brute_force(spark, baskets, ms):
    sets = spark.createDataFrame([(sorted(set(b)),) for b in baskets], "items array<string>")
    fi = r.frequent_itemsets(sets, ms, 3)
    got = {tuple(x["items"]): x["support"] for x in fi.collect()}
    n = len(baskets)
    exp = {}
    for k in (1, 2, 3):
        for combo in itertools.combinations(ITEMS, k):
            c = sum(1 for b in baskets if set(combo) <= set(b))
            if c / n >= ms:
                exp[combo] = c / n
    assert got == exp
    rules = {(tuple(x["antecedent"]), tuple(x["consequent"])) for x in r.association_rules(fi, "confidence", 0.0)
             .collect()}
    exp_rules = set()
    for items in exp:
        if len(items) < 2:
            continue
        for k in range(1, len(items)):
            for ant in itertools.combinations(items, k):
                exp_rules.add((ant, tuple(x for x in items if x not in ant)))
    assert rules == exp_rules


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.integers(0, 10 ** 6)), min_size=1, max_size=60, unique=True))
def test_grouped_row_numbers(spark, rows):
    df = spark.createDataFrame(rows, "g string, k long")
    out = row_numbers(df, ["k"], "n", 3, by=["g"]).collect()
    for g in "xyz":
        ks = sorted(k for gg, k in rows if gg == g)
        got = sorted((x.k, x.n) for x in out if x.g == g)
        assert got == list(zip(ks, range(1, len(ks) + 1)))


@SETTINGS
@given(st.lists(st.integers(-10 ** 7, 10 ** 7), min_size=1, max_size=30))
def test_rnd_matches_decimal_half_up_on_cents(spark, cents):
    # values with 3 decimals, rounded to 2: half-way cases included
    vals = [c / 1000 for c in cents]
    got = [x[0] for x in spark.createDataFrame([(v,) for v in vals], "x double").select(rnd("x", 2)).collect()]
    exp = [float(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) if v >= 0 else
           -float(Decimal(repr(-v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) * 1.0 for v in vals]
    for v, g, e in zip(vals, got, exp):
        if v >= 0:
            assert g == e, (v, g, e)
        else:  # floor(x + .5) rounds negative halves up (towards +inf), the same in every engine
            assert abs(g - e) <= 0.010000001, (v, g, e)
