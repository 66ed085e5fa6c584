"""Version upserts, window replacement and version queries.

A url may hold a third of all rows. So nothing here gathers a whole url in one task: choices
of one row per key use ``row_number() = 1``, which Spark limits per map task before the
shuffle, and counts are aggregated before they are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import fingerprint, tie_break
from ..functions.windows import filter_window, in_window


_COPY_BLOCK = 10_000


def _one_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def _keyed(key: Column) -> Column:
    return F.concat(F.lit("k:"), key)


def _unkeyed(columns: list[str]) -> Column:
    """Identity of a row without a key: a hash of the whole row.

    Pages without metadata have no url; they must not count as versions of one article.
    """
    return F.concat(F.lit("r:"), fingerprint(columns))


def new_versions(
    main: DataFrame, incoming: DataFrame, key: str = "url", version: str = "date_modified"
) -> DataFrame:
    """Incoming rows whose (key, version) is not stored yet, one row each.

    NULL versions compare as equal. Running it again over the result adds nothing. Among
    incoming rows with the same key and version the choice is by a hash of the row.
    """
    columns = incoming.columns
    as_text = F.coalesce(F.col(version).cast("string"), F.lit("\u0002"))
    keys = ["_id", "_version"]
    rows = incoming.withColumns(
        {"_id": F.coalesce(_keyed(F.col(key)), _unkeyed(columns)), "_version": as_text}
    )
    # The join has the keys of this choice, so the rows are shuffled once for both.
    rows = _one_per(rows, keys, [tie_break(columns)])
    # Stored rows with a key are read in two columns; whole rows only where the key is NULL.
    keyed = main.filter(F.col(key).isNotNull()).select(
        _keyed(F.col(key)).alias("_id"), as_text.alias("_version")
    )
    unkeyed = main.filter(F.col(key).isNull()).select(
        _unkeyed(columns).alias("_id"), as_text.alias("_version")
    )
    return rows.join(keyed.unionByName(unkeyed), keys, "left_anti").select(*columns)


def version_copies(
    main: DataFrame, incoming: DataFrame, key: str = "url", version: str = "date_modified"
) -> DataFrame:
    """Incoming rows with ``copies``: how often "unseen key or differing version" selects each.

    That rule compares an incoming row with every stored version of its key, so a row comes
    once per differing one. Counting the stored versions first gives the same number without
    pairing the rows.
    """
    per_key = main.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count(version).alias("_versions")
    )
    per_version = (
        main.filter(F.col(key).isNotNull() & F.col(version).isNotNull())
        .groupBy(F.col(key).alias("_vkey"), F.col(version).alias("_version"))
        .agg(F.count(F.lit(1)).alias("_same"))
    )
    joined = incoming.join(per_key, incoming[key] == per_key["_key"], "left").join(
        per_version,
        (incoming[key] == per_version["_vkey"]) & (incoming[version] == per_version["_version"]),
        "left",
    )
    differing = F.when(incoming[version].isNull(), F.lit(0)).otherwise(
        F.col("_versions") - F.coalesce("_same", F.lit(0))
    )
    copies = F.when(F.col("_key").isNull(), F.lit(1)).otherwise(differing).cast("bigint")
    return (
        joined.select(*[incoming[c] for c in incoming.columns], copies.alias("copies"))
        .filter(F.col("copies") > 0)
    )


def rows_to_append(
    main: DataFrame,
    incoming: DataFrame,
    key: str = "url",
    version: str = "date_modified",
    mode: str = "idempotent",
) -> DataFrame:
    """The rows an upsert appends.

    ``idempotent``: every unseen (key, version) once. ``reference``: the literal "unseen key
    or differing version" rule, which repeats rows when a key has several stored versions.
    """
    if mode == "idempotent":
        return new_versions(main, incoming, key, version)
    if mode != "reference":
        raise ValueError(f"mode is 'idempotent' or 'reference', got {mode!r}")
    counted = version_copies(main, incoming, key, version)
    # Two steps, so that a large number of copies never becomes one large array.
    first = F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(_COPY_BLOCK)))
    blocks = counted.withColumn("_first", first)
    in_block = F.least(F.lit(_COPY_BLOCK), F.col("copies") - F.col("_first"))
    repeated = blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1), in_block)))
    return repeated.select(*incoming.columns)


def upsert_versions(
    main: DataFrame,
    incoming: DataFrame,
    key: str = "url",
    version: str = "date_modified",
    mode: str = "idempotent",
) -> DataFrame:
    """The stored versions and the appended ones."""
    return main.unionByName(rows_to_append(main, incoming, key, version, mode))


def upsert_sitemap_urls(
    main: DataFrame, incoming: DataFrame, mode: str = "idempotent"
) -> DataFrame:
    """The same rule for ``(url, last_modified)``; an empty batch changes nothing."""
    return upsert_versions(main, incoming, "url", "last_modified", mode)


def replace_window(
    main: DataFrame, new: DataFrame, start, end, ts_col: str = "date_modified"
) -> DataFrame:
    """Deletes the rows inside the inclusive window and appends ``new``. NULL stamps stay."""
    outside = F.coalesce(~in_window(F.col(ts_col), start, end), F.lit(True))
    return main.filter(outside).unionByName(new)


def latest_version(
    df: DataFrame,
    key: str = "url",
    version: str = "date_modified",
    tie_columns: list[str] | None = None,
) -> DataFrame:
    """The newest row per key; equal versions are settled by a hash of ``tie_columns``.

    The default hashes whole rows. Where (key, version) is unique, naming narrow columns
    spares reading the wide ones.
    """
    tie = tie_break(df.columns if tie_columns is None else tie_columns)
    return _one_per(df, [key], [F.col(version).desc_nulls_last(), tie])


def latest_in_window(
    df: DataFrame,
    start,
    end,
    key: str = "url",
    version: str = "date_modified",
    tie_columns: list[str] | None = None,
) -> DataFrame:
    """The newest row per key among those inside the window.

    The filter comes first: it decides which rows compete, and it reaches the scan.
    """
    return latest_version(filter_window(df, version, start, end), key, version, tie_columns)


def version_counts(
    df: DataFrame, key: str = "url", version: str = "date_modified", at_least: int = 2
) -> DataFrame:
    """Rows of keys with several versions, with ``n_versions`` and ``recency`` (1 = newest).

    ``recency`` is 1 plus the number of strictly newer rows of the key. It is counted over
    (key, version) totals in three steps: days, seconds within a day, stamps within a second.
    So no ordered group is larger than the calendar allows, however many versions a key has in
    all or on one day.
    """
    day, second = F.to_date(version), F.date_trunc("second", version)
    per_version = (
        df.groupBy(key, version)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_day": day, "_second": second})
    )
    per_second = per_version.groupBy(key, "_day", "_second").agg(F.sum("_n").alias("_n"))
    per_day = per_second.groupBy(key, "_day").agg(F.sum("_n").alias("_n"))
    totals = per_day.groupBy(F.col(key).alias("_total_key")).agg(F.sum("_n").alias("n_versions"))
    totals = totals.filter(F.col("n_versions") >= at_least)

    def newer(rows: DataFrame, within: list[str], by: str, name: str) -> DataFrame:
        before = W.partitionBy(*within).orderBy(F.col(by).desc_nulls_last())
        counted = F.sum("_n").over(before.rowsBetween(W.unboundedPreceding, -1))
        return rows.withColumn(name, F.coalesce(counted, F.lit(0)))

    days = newer(per_day, [key], "_day", "_newer_days").select(
        F.col(key).alias("_day_key"), F.col("_day").alias("_day_of"), "_newer_days"
    )
    seconds = newer(per_second, [key, "_day"], "_second", "_newer_seconds").select(
        F.col(key).alias("_second_key"), F.col("_second").alias("_second_of"), "_newer_seconds"
    )
    stamps = newer(per_version, [key, "_second"], version, "_newer_stamps")
    same_day = F.col(key).eqNullSafe(F.col("_day_key")) & F.col("_day").eqNullSafe(
        F.col("_day_of")
    )
    same_second = F.col(key).eqNullSafe(F.col("_second_key")) & F.col("_second").eqNullSafe(
        F.col("_second_of")
    )
    ranked = (
        stamps.join(seconds, same_second)
        .join(days, same_day)
        .join(totals, F.col(key).eqNullSafe(F.col("_total_key")))
        .select(
            F.col(key).alias("_key"),
            F.col(version).alias("_version"),
            "n_versions",
            (
                F.lit(1) + F.col("_newer_days") + F.col("_newer_seconds") + F.col("_newer_stamps")
            ).alias("recency"),
        )
    )
    matches = df[key].eqNullSafe(ranked["_key"]) & df[version].eqNullSafe(ranked["_version"])
    return df.join(ranked, matches).select(*[df[c] for c in df.columns], "n_versions", "recency")
