"""Joins between id lists, claims and hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlode.functions.text import strip_space
from claimlode.session import stored

# A key holding more rows than this is spread over several tasks.
SPREAD_ROWS = 1_000_000
# Share of all rows above which a key may count as hot; at most 1 / share keys can.
SPREAD_SHARE = 4_096
# Hits of one search are broadcast against the text table up to this many rows.
BROADCAST_HITS = 500_000


def spread_join(
    many: DataFrame,
    few: DataFrame,
    key: str,
    how: str = "inner",
    spread_by: Sequence[str] = (),
    hot_rows: int = SPREAD_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Equi-join on ``key`` where single keys may hold a large part of ``many``.

    Hot keys are cut into slices of about ``hot_rows`` rows and only their rows of ``few`` are
    repeated, once per slice. ``how`` is 'inner' or 'left' (keeps all of ``many``). At most
    ``SPREAD_SHARE`` keys can pass the threshold, so broadcasting the hot-key list is bounded.
    ``rows`` is the size of ``many`` when the caller has counted it already.
    """
    total = many.count() if rows is None else rows
    if total <= hot_rows:
        return many.join(few, key, how)
    limit = max(hot_rows, total // SPREAD_SHARE)
    hot = (
        many.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > limit)
        .select(key, F.ceil(F.col("_rows") / limit).cast("int").alias("_slices"))
    )
    # The partition id spreads even rows that are equal in every column.
    row_hash = F.xxhash64(*(spread_by or many.columns), F.spark_partition_id())
    slices = F.coalesce("_slices", F.lit(1)).cast("bigint")
    cut = many.join(F.broadcast(hot), key, "left").withColumn("_slice", F.pmod(row_hash, slices))
    repeated = few.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))
    )
    joined = cut.drop("_slices").join(repeated.drop("_slices"), [key, "_slice"], how)
    return joined.drop("_slice")


def grid_cut(
    left: DataFrame, right: DataFrame, key: str, left_rows: int, right_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_left_part`` and ``_right_part``: equal keys meet in a grid of parts.

    A key with more than ``left_rows`` or ``right_rows`` rows is cut on that side into parts of about so many, and
    each part is repeated for the other side's parts, so that every pair of rows meets exactly
    once. The list of cut keys is stored before it is joined: the planner knows its size, which is at
    most the rows of a side divided by its limit.
    """

    def parts(rows: DataFrame, limit: int, name: str) -> DataFrame:
        long = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
        return long.select(key, F.ceil(F.col("_n") / limit).cast("int").alias(name))

    cuts = parts(left, left_rows, "_a").join(parts(right, right_rows, "_b"), key, "full")
    cuts = stored(cuts.select(key, F.coalesce("_a", F.lit(1)).alias("_a"), F.coalesce("_b", F.lit(1)).alias("_b")), "cuts")

    def dealt(rows: DataFrame, mine: str, theirs: str, part: str, other: str) -> DataFrame:
        # The partition id, taken before the join, spreads even rows that are equal in every column.
        hashed = rows.withColumn("_spread", F.xxhash64(*rows.columns, F.spark_partition_id()))
        own = F.pmod("_spread", F.coalesce(mine, F.lit(1)).cast("bigint")).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.coalesce(theirs, F.lit(1)) - 1))
        return hashed.join(cuts, key, "left").withColumn(part, own).withColumn(other, each).drop("_a", "_b", "_spread")

    return (
        dealt(left, "_a", "_b", "_left_part", "_right_part"),
        dealt(right, "_b", "_a", "_right_part", "_left_part"),
    )


def grid_join(left: DataFrame, right: DataFrame, key: str, left_rows: int = SPREAD_ROWS, right_rows: int = SPREAD_ROWS) -> DataFrame:
    """Inner equi-join where one key may hold a large part of both sides: see :func:`grid_cut`."""
    a, b = grid_cut(left, right, key, left_rows, right_rows)
    return a.join(b, [key, "_left_part", "_right_part"]).drop("_left_part", "_right_part")


def left_join_1n(left: DataFrame, right: DataFrame, on: str, **spread) -> DataFrame:
    """Left join that fails when a key repeats on the left; unmatched left rows stay.

    Written as inner join plus unmatched rows, because a hot key sits on the right and Spark
    cannot split the right side of a left join.
    """
    repeats = left.groupBy(on).count().where((F.col("count") > 1) & F.col(on).isNotNull())
    first = repeats.limit(1).collect()
    if first:
        raise ValueError(f"left side is not unique on {on}: {first[0][on]!r}")
    extra = [name for name in right.columns if name != on]
    columns = [*left.columns, *extra]
    matched = spread_join(right, left, on, "inner", **spread).select(*columns)
    unmatched = left.join(right.select(on).distinct(), on, "left_anti")
    empty = {name: F.lit(None).cast(right.schema[name].dataType) for name in extra}
    return matched.unionByName(unmatched.withColumns(empty).select(*columns))


def attach_metadata(
    hits: DataFrame, meta: DataFrame, on: str = "row_id", hit_rows: int | None = None
) -> DataFrame:
    """Add text columns to hits by row id.

    ``hit_rows`` is an upper bound of the hit count known to the caller (queries x k). Below
    ``BROADCAST_HITS`` the hits are broadcast, so the text table is scanned but never shuffled.
    """
    if hit_rows is not None and hit_rows <= BROADCAST_HITS:
        joined = meta.join(F.broadcast(hits), on)
    else:
        # The planner sizes hits by the corpus they came from; the hint keeps it from broadcasting many.
        joined = hits.join(meta.hint("merge"), on)
    return joined.select(on, *(c for c in [*meta.columns, *hits.columns] if c != on))


def filter_ids(
    df: DataFrame, list_a: DataFrame | Sequence[str], list_b: DataFrame | Sequence[str], on: str
) -> DataFrame:
    """Rows whose id is in either list, flagged ``in_a`` / ``in_b``.

    Python sequences become a pushed-down IN filter; DataFrames are joined.
    """
    if not isinstance(list_a, DataFrame) and not isinstance(list_b, DataFrame):
        flags = {"in_a": F.col(on).isin(list(list_a)), "in_b": F.col(on).isin(list(list_b))}
        wanted = df.where(F.col(on).isin([*list_a, *list_b]))
        return wanted.withColumns(flags)
    schema = f"{on} string"
    sides = []
    for flag, ids in (("in_a", list_a), ("in_b", list_b)):
        if not isinstance(ids, DataFrame):
            ids = df.sparkSession.createDataFrame([(i,) for i in ids], schema)
        sides.append(ids.select(on, *[F.lit(flag == name).alias(name) for name in ("in_a", "in_b")]))
    merged = sides[0].union(sides[1]).where(F.col(on).isNotNull())
    flags = merged.groupBy(on).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return spread_join(df, flags, on)


def _with_key(df: DataFrame, text: str) -> DataFrame:
    # SHA-256 of the stripped text is its identity: the join then moves 64 characters, not texts.
    return df.where(F.col(text).isNotNull()).withColumn(
        "text_key", F.sha2(strip_space(F.col(text)), 256)
    )


def match_groups(a: DataFrame, b: DataFrame, id_col: str, text: str) -> DataFrame:
    """Texts present on both sides, with the row and distinct-id counts of each side.

    One row per text and linear work: the form to use when single texts are copied very often.
    """

    def side(df: DataFrame, tag: str) -> DataFrame:
        # Two-level count: pre-aggregate per (text, id), so a hot text is spread over its ids.
        pairs = _with_key(df, text).groupBy("text_key", id_col).agg(F.count("*").alias("_n"))
        return pairs.groupBy("text_key").agg(
            F.sum("_n").alias(f"rows_{tag}"),
            F.count(id_col).alias(f"ids_{tag}"),
            F.min(id_col).alias(f"first_{tag}"),
        )

    return side(a, "a").join(side(b, "b"), "text_key")


def exact_text_match(
    a: DataFrame, b: DataFrame, id_col: str, text: str, hot_rows: int = SPREAD_ROWS
) -> DataFrame:
    """All (a, b) row pairs of equal stripped text, with a's untouched text.

    Rows are matched by text key, and only rows with a partner reach the pair join. A text copied on
    both sides is cut on both, into parts of ``hot_rows`` rows. The result itself has rows_a x rows_b
    lines per text, so on two big collections of copies use :func:`match_groups`.
    """
    keyed_a, keyed_b = _with_key(a, text), _with_key(b, text)
    common = keyed_a.select("text_key").distinct().join(keyed_b.select("text_key").distinct(), "text_key", "left_semi")
    common = stored(common, "common-texts")
    left = keyed_a.join(common, "text_key", "left_semi").select(
        "text_key", F.col(id_col).alias("patent_a"), F.col(text).alias("matched_claim")
    )
    right = keyed_b.join(common, "text_key", "left_semi").select(
        "text_key", F.col(id_col).alias("patent_b")
    )
    return grid_join(left, right, "text_key", hot_rows, hot_rows).select("patent_a", "patent_b", "matched_claim")


def keep_in_list(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """All rows whose id is in the list."""
    return df.join(ids.select(on).where(F.col(on).isNotNull()).distinct(), on, "left_semi")


def id_difference(ids: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Distinct non-null ids of ``ids`` that ``other`` lacks."""
    wanted = ids.select(on).where(F.col(on).isNotNull()).distinct()
    return wanted.join(other.select(on).distinct(), on, "left_anti")


def id_intersection(ids: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Distinct ids present on both sides."""
    wanted = ids.select(on).where(F.col(on).isNotNull()).distinct()
    return wanted.join(other.select(on).distinct(), on, "left_semi")


def missing_ids(ids: DataFrame, corpus: DataFrame, on: str, n: int | None = None) -> DataFrame:
    """List all ids without a corpus row, sorted as text; or the first ``n``."""
    missing = id_difference(ids, corpus, on).orderBy(on)
    return missing if n is None else missing.limit(n)


def attach_external(check: DataFrame, external: DataFrame, on: str = "query_id") -> DataFrame:
    """Add each query's outside result list by query id; queries without one keep null."""
    return check.join(external, on, "left")


def overlap_counts(left: DataFrame, right: DataFrame, group: str, item: str) -> DataFrame:
    """(group, overlap): how many different items of a group's left rows are among its right rows; 0 for none.

    Items meet by (group, item), so neither a group's list nor its rows are gathered.
    """
    mine = left.where(F.col(group).isNotNull()).select(group, item).distinct()
    shared = mine.where(F.col(item).isNotNull()).join(right.select(group, item).distinct(), [group, item], "left_semi")
    found = shared.select(group, F.lit(1).alias("_one"))
    none = mine.select(group).distinct().select(group, F.lit(0).alias("_one"))
    return found.unionByName(none).groupBy(group).agg(F.sum("_one").cast("int").alias("overlap"))


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> Column:
    """Aggregate counting distinct non-null ids."""
    return (F.approx_count_distinct if approximate else F.count_distinct)(df[column])
