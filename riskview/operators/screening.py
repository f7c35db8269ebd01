"""Sanctions screening: exact membership and fuzzy (edit distance) matching.

Neither form collects the watchlist to the driver.  The exact screen is a
left join to the *distinct* names (unique build keys, so no fan-out, and AQE
may split a hot customer name); the fuzzy screen is an exact
deletion-neighbourhood equi-join verified with ``levenshtein`` - no cross
join, and screening runs once per distinct name, not per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskview.operators.joins import broadcast_if_small

# Broadcast bounds (rows), proven by a count before the hint:
# distinct listed names (~100 MB hashed at 1M names) and the listed side's
# deletion variants (~300 MB at 5M variants, i.e. ~250k names of ~20
# characters at distance 1).  A larger list falls back to a shuffled join.
LIST_BROADCAST_MAX_ROWS = 1_000_000
VARIANT_BROADCAST_MAX_ROWS = 5_000_000


def normalize_name(c: Column) -> Column:
    """Case- and whitespace-insensitive form of a name."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def watchlist_names(watchlist: DataFrame, include_alias: bool = False,
                    normalize: bool = False) -> DataFrame:
    """Distinct non-null listed names (column ``entity_name``)."""
    names = watchlist.select("entity_name")
    if include_alias and "alias" in watchlist.columns:
        names = names.unionByName(
            watchlist.select(F.col("alias").alias("entity_name")))
    if normalize:
        names = names.select(normalize_name(F.col("entity_name")).alias("entity_name"))
    return names.filter(F.col("entity_name").isNotNull()).distinct()


def with_aml_flag(customers: DataFrame, watchlist: DataFrame,
                  name_col: str = "full_name", include_alias: bool = False,
                  normalize: bool = False,
                  broadcast_max_rows: int | None = LIST_BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ``aml_flag``: the name equals a listed name; NULL name -> false.

    The distinct listed names are broadcast once a count proves they
    fit ``broadcast_max_rows`` (the planner would size them by the raw list
    file instead); otherwise the join shuffles and AQE may split a hot name.
    """
    hits = (watchlist_names(watchlist, include_alias, normalize)
            .select(F.col("entity_name").alias("__rv_name"),
                    F.lit(True).alias("__rv_hit")))
    if broadcast_max_rows is not None:
        hits = broadcast_if_small(hits, broadcast_max_rows)
    key = normalize_name(F.col(name_col)) if normalize else F.col(name_col)
    return (customers.join(hits, key == F.col("__rv_name"), "left")
            .withColumn("aml_flag", F.coalesce(F.col("__rv_hit"), F.lit(False)))
            .drop("__rv_name", "__rv_hit"))


def watchlist_screen(customers: DataFrame, watchlist: DataFrame, **kw) -> DataFrame:
    return (with_aml_flag(customers, watchlist, **kw)
            .select("customer_id", "full_name", "country", "pep_flag", "aml_flag"))


def deletion_variants(name: Column, k: int) -> Column:
    """The name plus every string obtained by deleting up to ``k`` characters.

    Two strings are within edit distance ``k`` only if they share such a
    variant, so an equi-join on variants finds every candidate pair.
    """
    def one_step(x: Column) -> Column:
        n = F.length(x)
        dels = F.transform(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: F.concat(x.substr(F.lit(1), i - 1), x.substr(i + 1, n)))
        return F.array_union(F.array(x), dels)

    v = F.array(name)
    for _ in range(k):
        v = F.array_distinct(F.flatten(F.transform(v, one_step)))
    return v


def _variants_at_most(names: DataFrame, col: str, k: int) -> int:
    """A bound on the rows that ``deletion_variants`` makes, without making
    them: a name of length L has at most (L + 1) ** k + 1 variants."""
    n = names.agg(F.sum(F.pow(F.length(col) + 1, F.lit(k)) + 1)).first()[0]
    return int(n or 0)


def fuzzy_name_pairs(names: DataFrame, listed: DataFrame, max_dist: int = 1,
                     broadcast_max_rows: int | None = VARIANT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Every pair of a distinct name and a listed name within ``max_dist``
    edits: ``name, entity_name, distance``.

    ``names(name)`` and ``listed(entity_name)`` are distinct name sets.  The
    listed side's variants (a few dozen per listed name) are broadcast once
    proven below ``broadcast_max_rows``, so the exploded customer names are
    joined where they are, without a shuffle.  Pairs that share several
    variants are verified once.
    """
    cv = names.select("name", F.explode(deletion_variants(F.col("name"), max_dist))
                      .alias("__rv_v"))
    lv = listed.select("entity_name",
                       F.explode(deletion_variants(F.col("entity_name"), max_dist))
                       .alias("__rv_v"))
    if broadcast_max_rows is not None and \
            _variants_at_most(listed, "entity_name", max_dist) <= broadcast_max_rows:
        lv = F.broadcast(lv)
    near = F.abs(F.length("name") - F.length("entity_name")) <= max_dist
    pairs = cv.join(lv, "__rv_v").filter(near).select("name", "entity_name").distinct()
    dist = F.levenshtein(F.col("name"), F.col("entity_name"), max_dist)
    return (pairs.withColumn("distance", dist)
            .filter((F.col("distance") >= 0) & (F.col("distance") <= max_dist)))


def fuzzy_name_matches(names: DataFrame, listed: DataFrame, max_dist: int = 1,
                       broadcast_max_rows: int | None = VARIANT_BROADCAST_MAX_ROWS
                       ) -> DataFrame:
    """Best listed name per distinct name within ``max_dist`` edits: ``name,
    entity_name, distance``; ties go to the smallest name."""
    best = (fuzzy_name_pairs(names, listed, max_dist, broadcast_max_rows)
            .groupBy("name").agg(F.min(F.struct("distance", "entity_name")).alias("__rv_b")))
    return best.select("name", "__rv_b.entity_name", "__rv_b.distance")


def fuzzy_screen(customers: DataFrame, watchlist: DataFrame, max_dist: int = 1,
                 name_col: str = "full_name", include_alias: bool = False,
                 normalize: bool = False, all_hits: bool = False,
                 broadcast_max_rows: int | None = VARIANT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Customers whose name is within ``max_dist`` edits of a listed name:
    ``customer_id, entity_name, distance`` - the closest, then smallest name,
    or with ``all_hits`` every one.  ``include_alias`` and ``normalize`` are
    those of the exact screen."""
    key = normalize_name(F.col(name_col)) if normalize else F.col(name_col)
    keyed = customers.select("customer_id", key.alias("name")).filter(F.col("name").isNotNull())
    match = fuzzy_name_pairs if all_hits else fuzzy_name_matches
    hits = match(keyed.select("name").distinct(), watchlist_names(watchlist, include_alias, normalize),
                 max_dist, broadcast_max_rows)
    # (no size check on ``hits``: counting it would run the whole match
    # twice; the planner and AQE size it, and the customer side of this join
    # is pruned to id and name)
    return keyed.join(hits, "name").select("customer_id", "entity_name", "distance")
