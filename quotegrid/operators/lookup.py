"""Look-ups by normalised name, and the choice between two sources of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotegrid.functions.text import normalized_name


def find_municipalities(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Id of each requested municipality, or the reason there is none.

    ``requests``: name, province. ``catalog``: municipality_id, municipality, province, position (its
    order in the list). Names compare without accents and case. Only where a name occurs more than
    once the province decides, by containing the requested text; the first match in the list wins.
    """
    wanted = requests.select("name", "province").distinct().withColumns(
        {"_name": normalized_name("name"), "_province": normalized_name("province")}
    )
    listed = catalog.select(
        normalized_name("municipality").alias("_name"), normalized_name("province").alias("_in"),
        F.struct("position", "municipality_id").alias("_entry"),
    )
    in_province = F.contains(F.col("_in"), F.col("_province"))
    matches = wanted.join(listed, "_name", "left").groupBy("name", "province").agg(
        F.count("_entry").alias("n_matches"),
        F.min("_entry").alias("_first"),
        F.min(F.when(in_province, F.col("_entry"))).alias("_first_in"),
    )
    chosen = F.when(F.col("n_matches") == 1, F.col("_first")).otherwise(F.col("_first_in"))
    error = F.when(F.col("n_matches") == 0, "unknown_municipality").when(
        chosen.isNull(), "not_in_province"
    )
    return matches.select(
        "name", "province", "n_matches", chosen["municipality_id"].alias("municipality_id"), error.alias("error")
    )


def find_provinces(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Id of each requested province by normalised name; the id may stand under either key.

    ``catalog``: IDPovincia, IDProvincia, province, position.
    """
    province_id = F.coalesce(F.nullif(F.col("IDPovincia"), F.lit("")), F.col("IDProvincia"))
    listed = catalog.select(
        normalized_name("province").alias("_name"), F.struct("position", province_id.alias("id")).alias("_entry")
    )
    wanted = requests.select("name").distinct().withColumn("_name", normalized_name("name"))
    return wanted.join(listed, "_name", "left").groupBy("name").agg(F.min("_entry").alias("_first")).select(
        "name", F.col("_first.id").alias("province_id"),
        F.when(F.col("_first").isNull(), "unknown_province").alias("error"),
    )


def with_fallback(
    primary: DataFrame, fallback: DataFrame, keys: Sequence[str] = ("date",), municipality: str | None = None
) -> DataFrame:
    """The primary records, and for keys without any the fallback records of the municipality."""
    if municipality is not None:
        fallback = fallback.where(normalized_name("municipality") == normalized_name(F.lit(municipality)))
    covered = primary.select(*keys).distinct()
    return primary.unionByName(fallback.join(covered, list(keys), "left_anti"))
