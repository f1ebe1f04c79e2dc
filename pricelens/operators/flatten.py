"""Flatten the three nested tables into one row per rate (Q2, Q3) or per NPI (Q4).

Plan shape (all DataFrame operators, no UDF):

    in_network --explode rates--explode references--+
                                                    +-- join on (document, group id) -- explode prices -- select
    providers --join base on document (broadcast)---+

* The provider side (providers x base, one row per group and document) is the
  small side. It is broadcast only when the plan's statistics bound its bytes
  (``plans.joins.fits_broadcast``, no job); beyond it the join is a shuffle join
  and AQE splits skewed reference keys on the rates side.
* Prices are exploded after the join, so the prices array travels through the
  join once per reference instead of once per price.
* The reference pipeline wrote ``full_outer`` joins whose later ``explode`` turns
  them into right outer (rates) and inner (NPI) joins; we write those joins
  directly. The NULL-preserving variant keeps providers without any rate by a
  ``left_anti`` join against the distinct references, instead of a full outer
  join that could neither broadcast nor split a hot key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast
from ..schemas import BASE_FIELDS, DOC_KEY, NPI_RATES_COLUMNS, PRICE_FIELDS, RATES_COLUMNS
from .unnest import flatten_present, unnest

RATE_COL = "exploded_negotiated_rates"
PRICES_COL = "exploded_negotiated_rates_negotiated_prices"
REF_COL = "exploded_negotiated_rates_provider_references"
NPI_BYTES = 8
REFERENCES_TOGETHER = 16  # references of a rate that are placed as one row
ITEM_COLUMNS = ["billing_code", "billing_code_type", "billing_code_type_version", "description", "name"]


def _mark(counter, name: str, df: DataFrame) -> DataFrame:
    return counter.mark(name, df) if counter is not None else df


def attach_base(providers: DataFrame, base: DataFrame, columns: list[str] | None = None,
                counter=None) -> DataFrame:
    """J1: every provider row gets the header of its document.

    An equi-join on the document key instead of a cross join: with one document
    it gives the same rows, with many it does not multiply documents together.
    A document without a header row loses its providers, as a cross join with an
    empty side would. The header table is broadcast when its bytes are bounded.
    """
    cols = columns or providers.columns
    b = base.select(DOC_KEY, *BASE_FIELDS)
    small = fits_broadcast(b)
    b = _mark(counter, "base", b)
    p = _mark(counter, "provider_references", providers.select(*cols))
    return _mark(counter, "providers_with_base", p.join(F.broadcast(b) if small else b, DOC_KEY, "inner"))


def explode_rates(in_network: DataFrame, extra: list[str] | None = None, keep_empty: bool = False) -> DataFrame:
    """U1: one row per negotiated_rates element, with the item's columns."""
    keep = [DOC_KEY, *ITEM_COLUMNS, *(extra or []), "negotiation_arrangement"]
    return unnest(in_network, "negotiated_rates", RATE_COL, keep=keep, keep_empty=keep_empty)


def rate_references(in_network: DataFrame, extra: list[str] | None = None, keep_empty: bool = False,
                    rates: DataFrame | None = None) -> DataFrame:
    """U1 + P2 + U2: one row per (rate element, provider reference), prices kept as an array.
    ``rates``: the output of ``explode_rates`` when the caller already has it."""
    if rates is None:
        rates = explode_rates(in_network, extra, keep_empty)
    keep = [DOC_KEY, *ITEM_COLUMNS, *(extra or []),
            F.col(f"{RATE_COL}.negotiated_prices").alias(PRICES_COL), "negotiation_arrangement"]
    return unnest(rates, F.col(f"{RATE_COL}.provider_references"), REF_COL, keep=keep, keep_empty=keep_empty)


def placed_references(rates: DataFrame, place: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The output of ``explode_rates`` after a placement: a row for up to ``REFERENCES_TOGETHER`` references
    of a rate, so a rate's prices are shuffled once for that many of them and a rate with thousands of
    references still goes to several partitions. Rates without references drop out."""
    refs = F.col(f"{RATE_COL}.provider_references")
    firsts = F.sequence(F.lit(1), F.size(refs), F.lit(REFERENCES_TOGETHER))
    groups = F.when(F.size(refs) > 0, F.transform(firsts, lambda k: F.slice(refs, k, REFERENCES_TOGETHER)))
    keep = [c for c in rates.columns if c != RATE_COL]
    rows = rates.select(*keep, F.col(f"{RATE_COL}.negotiated_prices").alias(PRICES_COL), F.explode(groups).alias(REF_COL))
    return place(rows).select(*keep, F.struct(F.col(PRICES_COL).alias("negotiated_prices"),
                                              F.col(REF_COL).alias("provider_references")).alias(RATE_COL))


def used_references(in_network: DataFrame) -> DataFrame:
    """Distinct (document, reference) pairs. Reads only the references leaf of the
    nested column; the distinct is pre-aggregated on the map side, so a reference
    used a billion times crosses the shuffle once per map task."""
    refs = flatten_present(F.col("negotiated_rates.provider_references"))
    return (in_network.select(DOC_KEY, F.explode(refs).alias(REF_COL))
            .where(F.col(REF_COL).isNotNull()).distinct())


def _price_columns() -> list[Column]:
    return [F.col(f"{PRICES_COL}.{f}").alias(f) for f in PRICE_FIELDS]


def _join_providers(pb: DataFrame, rates: DataFrame, how: str, small: bool) -> DataFrame:
    p = (F.broadcast(pb) if small else pb).alias("p")
    r = rates.alias("r")
    cond = (F.col(f"p.{DOC_KEY}") == F.col(f"r.{DOC_KEY}")) & (F.col("p.provider_group_id") == F.col(f"r.{REF_COL}"))
    return p.join(r, cond, how)


def join_rates_providers(base: DataFrame, providers: DataFrame, in_network: DataFrame,
                         keep_unmatched: bool = False, counter=None,
                         cluster_by: str | Callable[[DataFrame], DataFrame] | None = None,
                         hash_providers: bool = False) -> DataFrame:
    """J2a (and J3 with ``keep_unmatched``): rate references joined with providers and
    header, prices still an array. Unknown references keep NULL provider columns;
    with ``keep_unmatched`` providers that no rate uses are added with NULL rate
    columns, and items without rates or references stay as NULL rows.

    The provider side is broadcast when the statistics bound its bytes, headers included. Beyond,
    ``hash_providers`` asks for a shuffled hash join on it: the rates, a wide row with a price array for
    each reference, are then not sorted; a partition of the providers must fit into a task's memory.

    ``cluster_by`` places the result. A placement by counted rows comes before the references are
    exploded where the join does not move rows afterwards.
    """
    if counter is not None and keep_unmatched:
        raise ValueError("stage counts are kept for the rate flatten without unmatched rows")
    providers = providers.select(DOC_KEY, "provider_group_id")
    pb = attach_base(providers, base, counter=counter)
    small = fits_broadcast(providers, widened=pb)  # one row for each provider
    marked = _mark(counter, "in_network", in_network)
    rates = _mark(counter, "rates_exploded", explode_rates(marked, keep_empty=keep_unmatched))
    early = callable(cluster_by) and small and not keep_unmatched
    if early:
        rates = placed_references(rates, cluster_by)
    refs = _mark(counter, "references_exploded", rate_references(marked, keep_empty=keep_unmatched, rates=rates))
    joined = _join_providers(pb.hint("shuffle_hash") if hash_providers and not small else pb, refs, "right", small).select(
        F.col(f"r.{DOC_KEY}").alias(DOC_KEY),
        *[F.col(f"p.{c}") for c in BASE_FIELDS], F.col("p.provider_group_id"),
        *[F.col(f"r.{c}") for c in ITEM_COLUMNS],
        F.col(f"r.{PRICES_COL}"), F.col(f"r.{REF_COL}"), F.col("r.negotiation_arrangement"))
    if keep_unmatched:
        # Providers that no rate refers to (NULL ids included): the left-only part
        # of a full outer join.
        lonely = pb.join(used_references(in_network).withColumnRenamed(REF_COL, "provider_group_id"),
                         [DOC_KEY, "provider_group_id"], "left_anti")
        joined = joined.unionByName(lonely, allowMissingColumns=True)
    if cluster_by and not early:
        # Cluster for the write before prices multiply the rows: the shuffle moves
        # one row per reference with its price array, not one wide row per price.
        joined = _clustered(joined, cluster_by)
    return _mark(counter, "joined", joined)


def _clustered(joined: DataFrame, by: str | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """By a column, sized by the bytes shuffled, or by a placement such as ``plans.layout.by_weight``."""
    return by(joined) if callable(by) else joined.hint("rebalance", by)


def flatten_rates(base: DataFrame, providers: DataFrame, in_network: DataFrame,
                  keep_unmatched: bool = False, keep_source: bool = False, counter=None,
                  cluster_by: str | Callable[[DataFrame], DataFrame] | None = None,
                  hash_providers: bool = False) -> DataFrame:
    """Q2 (and Q3 with ``keep_unmatched``): 19-column rate table, one row per
    (rate element, provider reference, price).

    Q2 drops items without rates, rates without references or prices, and
    providers no rate uses; rates whose reference is unknown keep NULL provider
    and header columns. Q3 keeps every one of those rows, with NULLs.
    """
    joined = join_rates_providers(base, providers, in_network, keep_unmatched, counter, cluster_by, hash_providers)
    keep = [DOC_KEY, *BASE_FIELDS, "provider_group_id", *ITEM_COLUMNS, REF_COL, "negotiation_arrangement"]
    out = unnest(joined, PRICES_COL, PRICES_COL, keep=keep, keep_empty=keep_unmatched)
    cols = ([DOC_KEY] if keep_source else []) + RATES_COLUMNS
    out = out.select(*keep[:-2], *_price_columns(), REF_COL, "negotiation_arrangement").select(*cols)
    return _mark(counter, "rates", out)


def npi_providers(base: DataFrame, providers: DataFrame) -> DataFrame:
    """U4 + U5 + P3 on the provider side: one row per (group id, npi) with the tin
    and the header. Providers without groups or npis drop out here, before the
    join, exactly as they would after it."""
    g = unnest(providers, "provider_groups", "g", keep=[DOC_KEY, "provider_group_id"])
    n = g.select(DOC_KEY, "provider_group_id", F.explode("g.npi").alias("npi"),
                 F.col("g.tin.type").alias("tin_type"), F.col("g.tin.value").alias("tin"))
    return attach_base(n, base)


def inline_npi_rates(base: DataFrame, in_network: DataFrame) -> DataFrame:
    """E1: rate elements that list their provider groups inline (instead of
    references), one row per (element, price, group, npi); provider_group_id is
    NULL, the header comes from the item's own document."""
    rates = explode_rates(in_network, extra=["covered_services"])
    g = unnest(rates, F.col(f"{RATE_COL}.provider_groups"), "g",
               keep=[DOC_KEY, *ITEM_COLUMNS, "covered_services",
                     F.col(f"{RATE_COL}.negotiated_prices").alias(PRICES_COL), "negotiation_arrangement"])
    n = g.select(*[c for c in g.columns if c != "g"], F.explode("g.npi").alias("npi"),
                 F.col("g.tin.type").alias("tin_type"), F.col("g.tin.value").alias("tin"))
    b = base.select(DOC_KEY, *BASE_FIELDS)
    n = n.join(F.broadcast(b) if fits_broadcast(b) else b, DOC_KEY, "inner")
    keep = [c for c in n.columns if c != PRICES_COL]
    out = unnest(n, PRICES_COL, PRICES_COL, keep=keep)
    return out.select(*keep, *_price_columns()).withColumn("provider_group_id", F.lit(None).cast("long"))


def flatten_npi_rates(base: DataFrame, providers: DataFrame, in_network: DataFrame,
                      keep_source: bool = False, include_inline: bool = False,
                      cluster_by: str | Callable[[DataFrame], DataFrame] | None = None,
                      hash_providers: bool = False) -> DataFrame:
    """Q4: 22-column table, one row per (rate element, reference, price, provider
    group, npi). Rates with an unknown reference have no npi and drop out, so the
    join is inner. ``hash_providers``: as in ``join_rates_providers``."""
    pn = npi_providers(base, providers)
    # A group may carry thousands of npis, so the bound is taken on the npis' own bytes.
    groups = providers.select(DOC_KEY, "provider_group_id", "provider_groups")
    small = fits_broadcast(groups, widened=pn, least_row=NPI_BYTES)
    rates = explode_rates(in_network, extra=["covered_services"])
    early = callable(cluster_by) and small
    if early:
        rates = placed_references(rates, cluster_by)
    rates = rate_references(in_network, extra=["covered_services"], rates=rates)
    joined = _join_providers(pn.hint("shuffle_hash") if hash_providers and not small else pn, rates, "inner", small).select(
        F.col(f"r.{DOC_KEY}"), *[F.col(f"p.{c}") for c in BASE_FIELDS],
        F.col("p.provider_group_id"), "p.npi", "p.tin_type", "p.tin",
        *[F.col(f"r.{c}") for c in ITEM_COLUMNS], "r.covered_services",
        F.col(f"r.{PRICES_COL}"), "r.negotiation_arrangement")
    if cluster_by and not early:
        joined = _clustered(joined, cluster_by)
    keep = [c for c in joined.columns if c != PRICES_COL]
    out = unnest(joined, PRICES_COL, PRICES_COL, keep=keep)
    cols = ([DOC_KEY] if keep_source else []) + NPI_RATES_COLUMNS
    out = out.select(*keep, *_price_columns()).select(*cols)
    if include_inline:
        out = out.unionByName(inline_npi_rates(base, in_network).select(*cols))
    return out
