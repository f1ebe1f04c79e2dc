"""Flatten semantics against a brute-force Python model on random nested inputs."""

from collections import Counter

from hypothesis import example, given, HealthCheck, settings
from hypothesis import strategies as st

from pricelens.operators.flatten import flatten_npi_rates, flatten_rates

from frames import base_rows, in_network, item, price, providers, rate

ids = st.one_of(st.none(), st.integers(0, 5))
arr = lambda inner: st.one_of(st.none(), st.lists(inner, max_size=3))
prices_st = arr(st.integers(1, 4).map(lambda x: price(float(x))))
rate_st = st.tuples(prices_st, arr(ids))
items_st = st.lists(st.tuples(st.sampled_from(["00001", "00002"]), arr(rate_st)), max_size=4)
providers_st = st.lists(st.tuples(ids, st.one_of(st.none(), st.lists(st.integers(10, 12), max_size=2))),
                        max_size=4)


def _model(items, provs, keep_unmatched):
    """The reference semantics, row by row: explode (or explode_outer) of rates,
    references and prices, and a right (or full) join on the provider id."""
    known = [p for p in provs if p[0] is not None]
    rows = Counter()
    used = set()
    for code, rates in items:
        rs = rates or ([None] if keep_unmatched else [])
        for r in rs:
            prices, refs = (r if r is not None else (None, None))
            refs_l = refs or ([None] if keep_unmatched else [])
            for ref in refs_l:
                matches = [p for p in known if ref is not None and p[0] == ref] or [None]
                for m in matches:
                    if m is not None:
                        used.add(m[0])
                    ps = prices or ([None] if keep_unmatched else [])
                    for pr in ps:
                        rows[(m[0] if m else None, code, ref, pr[4] if pr else None)] += 1
    if keep_unmatched:
        for p in provs:
            if p[0] is None or p[0] not in {r[2] for r in rows if r[2] is not None}:
                rows[(p[0], None, None, None)] += 1
    return rows


def _npi_model(items, provs):
    rows = Counter()
    for code, rates in items:
        for r in rates or []:
            prices, refs = r
            for ref in refs or []:
                for p in provs:
                    if ref is not None and p[0] == ref:
                        for npi in p[1] or []:
                            for pr in prices or []:
                                rows[(ref, npi, code, pr[4])] += 1
    return rows


def _frames(spark, items, provs):
    b = base_rows(spark)
    p = providers(spark, [("d1", pid, "https://a", None if npis is None else [(npis, ("ein", "x"))])
                          for pid, npis in provs])
    i = in_network(spark, [item(code, None if rates is None else [rate(*r) for r in rates])
                           for code, rates in items])
    return b, p, i


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example(items=[("00001", [(None, [0, None]), (None, None)])], provs=[(0, None)])
@given(items=items_st, provs=providers_st)
def test_flatten_matches_model(spark, items, provs):
    b, p, i = _frames(spark, items, provs)
    for keep in (False, True):
        got = Counter((r.provider_group_id, r.billing_code, r.exploded_negotiated_rates_provider_references,
                       r.negotiated_rate) for r in flatten_rates(b, p, i, keep_unmatched=keep).collect())
        assert got == _model(items, provs, keep), keep
    got = Counter((r.provider_group_id, r.npi, r.billing_code, r.negotiated_rate)
                  for r in flatten_npi_rates(b, p, i).collect())
    assert got == _npi_model(items, provs)
