"""Hand-made nested frames for edge cases (NULL and empty arrays, unmatched keys...)."""

from pricelens.schemas import BASE_TABLE, IN_NETWORK_TABLE, PROVIDERS_TABLE


def price(rate, cls="professional", typ="negotiated", codes=("01",)):
    return (None, cls, [], "2025-01-01", rate, typ, list(codes) if codes is not None else None)


def rate(prices, refs, groups=None):
    return (prices, refs, groups)


def item(code, rates, doc="d1", name="n", covered=None, bundled=None):
    return (doc, "ffs", name, "CPT", "2024", code, "desc", rates, covered, bundled)


def base_rows(spark, docs=("d1",)):
    return spark.createDataFrame([(d, "E", "insurer", "2024-12-01", "1.0.0", None, None, None, None) for d in docs],
                                 BASE_TABLE)


def providers(spark, rows):
    """rows: (doc, id, location, groups)"""
    return spark.createDataFrame(rows, PROVIDERS_TABLE)


def in_network(spark, rows):
    return spark.createDataFrame(rows, IN_NETWORK_TABLE)
