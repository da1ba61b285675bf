"""Work along a chromosome without a window per chromosome.

A chromosome is cut into tiles of fixed width. Rows of one tile are
pre-aggregated by position before they meet in a window, so a window group holds
at most a few entries per base of the tile however deep the data is. What has to
cross a tile edge is then settled among the first and last entry of every tile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .arith import idiv

TILE = 1 << 14


def tile_range(s: str | Column, e: str | Column, width: int) -> Column:
    """Array of the tiles that [s, e) touches; an empty interval touches the tile of its point."""
    s = F.col(s) if isinstance(s, str) else s
    e = F.col(e) if isinstance(e, str) else e
    return F.sequence(idiv(s, width), idiv(F.greatest(e - 1, s), width))


def clip_to_tiles(df: DataFrame, width: int = TILE) -> DataFrame:
    """Cut every interval at tile edges; adds ``tile``."""
    rest = [c for c in df.columns if c not in ("s", "e")]
    cut = df.select("*", F.explode(tile_range("s", "e", width)).alias("tile"))
    return cut.select(
        *rest,
        "tile",
        F.greatest(F.col("s"), F.col("tile") * width).alias("s"),
        F.least(F.col("e"), (F.col("tile") + 1) * width).alias("e"),
    )


def _events(df: DataFrame, keys: Sequence[str], weight: str | None, width: int) -> DataFrame:
    """(keys, tile, p, d, born): change of depth at p, and number of intervals that really start there.

    Two events per interval, summed by position on the map side first: a position
    that holds a third of all reads is one row when it reaches a window.
    """
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    whole = df.select(*keys, "s", "e", F.col("s").alias("origin"), w.alias("w")).filter("s < e")
    pieces = clip_to_tiles(whole, width)
    zero = F.lit(0).cast("bigint")
    born = F.when(F.col("s") == F.col("origin"), F.col("w")).otherwise(zero)
    up = F.struct(F.col("s").alias("p"), F.col("w").alias("d"), born.alias("born"))
    down = F.struct(F.col("e").alias("p"), (-F.col("w")).alias("d"), zero.alias("born"))
    return (
        pieces.select(*keys, "tile", F.inline(F.array(up, down)))
        .groupBy(*keys, "tile", "p")
        .agg(F.sum("d").alias("d"), F.sum("born").alias("born"))
    )


def depth_runs(df: DataFrame, keys: Sequence[str], weight: str | None = None, width: int = TILE,
               births: bool = False) -> DataFrame:
    """Number of intervals over each position, as runs of equal depth cut at tile edges.

    ``births`` adds the number of intervals that start with the run.
    """
    along = Window.partitionBy(*keys, "tile").orderBy("p")
    events = _events(df, keys, weight, width)
    if not births:  # where as many end as start the depth goes on
        events = events.filter("d <> 0")
    return (
        events.select(
            *keys,
            "tile",
            F.col("p").alias("s"),
            F.lead("p").over(along).alias("e"),
            F.sum("d").over(along).alias("depth"),
            *(["born"] if births else []),
        )
        .filter("e is not null and depth > 0")
    )


def _islands(
    df: DataFrame, part: Sequence[str], gap: int | str, same: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    far = F.col(gap) if isinstance(gap, str) else F.lit(gap)
    along = Window.partitionBy(*part).orderBy("s", "e")
    reach = F.max("e").over(along.rowsBetween(Window.unboundedPreceding, -1))
    fresh = reach.isNull() | (F.col("s") > reach + far)
    for c in same:
        fresh = fresh | ~F.lag(c).over(along).eqNullSafe(F.col(c))
    return (
        df.withColumn("fresh", fresh.cast("bigint"))
        .withColumn("island", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*part, "island", *same)
        .agg(F.min("s").alias("s"), F.max("e").alias("e"), *aggs)
    )


def join_runs(
    df: DataFrame, keys: Sequence[str], gap: int | str = 0, same: Sequence[str] = (), aggs: Sequence[Column] = ()
) -> DataFrame:
    """Join runs at most ``gap`` apart (and equal in ``same``), given runs that are cut at tile edges.

    ``gap`` is a number of bases or the name of a key column that holds one.

    First inside each tile; then only the first and last island of every tile are
    compared along the chromosome, at most two rows per tile. ``aggs`` must survive
    being applied twice (sum of sums, max of maxima) and keep their input name.
    """
    tile = [*keys, "tile"]
    local = _islands(df, tile, gap, same, aggs)
    last = F.max("island").over(Window.partitionBy(*tile))
    local = local.withColumn("edge", (F.col("island") == 1) | (F.col("island") == last))
    return _across_tiles(local.drop("island"), keys, gap, same, aggs)


def join_cut_runs(df: DataFrame, keys: Sequence[str], same: Sequence[str], width: int = TILE) -> DataFrame:
    """Join the parts of runs that were cut at tile edges; inside a tile there is nothing to join."""
    edge = (F.col("s") % width == 0) | (F.col("e") % width == 0)
    return _across_tiles(df.withColumn("edge", edge), keys, 0, same, ())


def _across_tiles(
    local: DataFrame, keys: Sequence[str], gap: int | str, same: Sequence[str], aggs: Sequence[Column]
) -> DataFrame:
    block = F.when(F.col("edge"), F.lit(-1)).otherwise(F.col("tile"))
    rows = local.withColumn("block", block).drop("tile", "edge")
    return _islands(rows, [*keys, "block"], gap, same, aggs).drop("block", "island")


def with_halo(df: DataFrame, pos: str, reach: int, width: int) -> DataFrame:
    """Copy each row into every tile within ``reach`` of it; ``own`` marks the home copy.

    A window over (keys, tile) then sees all neighbours of the tile's own rows.
    """
    p = F.col(pos)
    tiles = F.sequence(idiv(F.greatest(p - reach, F.lit(0)), width), idiv(p + reach, width))
    return df.select("*", F.explode(tiles).alias("tile")).withColumn("own", F.col("tile") == idiv(pos, width))
