"""Ordered work on series of any length.

``lag`` and running totals need the rows of a series in order, and a plain window puts a
whole series into one task. Here a series longer than ``spark.loadgrain.seriesRows`` is cut
into consecutive chunks of time, windows run per chunk, and what a chunk needs from earlier
ones comes from two small tables: its last rows (``with_lookback``) or its totals
(``with_carry``). Both hold a few rows per chunk.

Chunks are days; a day with too many rows is cut into hours, an hour with too many into minutes,
and such a minute into seconds, by exact counts, so bursts are cut where they are. With
one row per (series, microsecond), which ``merge_batches`` ensures, a chunk of one second
has at most a million rows. Chunk limits steer the speed only: any choice gives the same
result. Without long series the plan is the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadgrain.functions.columns import epoch_seconds, floor_div, join_null_safe
from loadgrain.plans.small import pin_small

CHUNK = "_chunk"
HALO = "_halo"
# lengths of chunks in seconds, each cut into the next where it has too many rows
CELLS = (86_400, 3_600, 60, 1)
SERIES_ROWS_CONF = "spark.loadgrain.seriesRows"
SERIES_ROWS = 4_000_000


def series_rows(df: DataFrame) -> int:
    """How many rows of one series a task may hold."""
    return int(df.sparkSession.conf.get(SERIES_ROWS_CONF, str(SERIES_ROWS)))


@dataclass(frozen=True)
class Series:
    """Rows of many series; ``CHUNK`` is set (not null) for the long ones only."""

    rows: DataFrame
    keys: tuple[str, ...]
    split: bool

    @property
    def parts(self) -> list[str]:
        return [*self.keys, CHUNK] if self.split else list(self.keys)

    def window(self, order: list[str]) -> WindowSpec:
        return Window.partitionBy(*self.parts).orderBy(*order)

    def with_rows(self, rows: DataFrame) -> Series:
        return replace(self, rows=rows)

    def finish(self) -> DataFrame:
        """The rows without the helper columns and the rows borrowed from earlier chunks."""
        if not self.split:
            return self.rows
        return self.own_rows().rows.drop(CHUNK)

    def own_rows(self) -> Series:
        if HALO not in self.rows.columns:
            return self
        return self.with_rows(self.rows.filter(~F.col(HALO)).drop(HALO))

    def with_lookback(self, order: list[str], columns: list[str], n: int) -> Series:
        """Give every chunk the last ``n`` rows before it, so ``lag`` and row frames see them."""
        if not self.split or n < 1:
            return self
        kept = list(dict.fromkeys([*self.keys, CHUNK, *order, *columns]))
        newest = Window.partitionBy(*self.parts).orderBy(*[F.desc(c) for c in order])
        tails = (
            self.rows.filter(F.col(CHUNK).isNotNull())
            .select(*kept)
            .withColumn("_back", F.row_number().over(newest))
            .filter(F.col("_back") <= n)
        )
        # one row per chunk: which chunks before it reach into the n rows before it, and where those rows end
        sizes = self.rows.filter(F.col(CHUNK).isNotNull()).groupBy(*self.parts).agg(F.count(F.lit(1)).alias("_size"))
        along = Window.partitionBy(*self.keys).orderBy(CHUNK)
        sizes = sizes.withColumns(
            {
                "_no": F.row_number().over(along),
                "_end": F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            }
        ).withColumn("_first", F.col("_end") - F.col("_size"))
        near = Window.partitionBy(*self.keys).orderBy("_first").rangeBetween(1 - n, Window.currentRow)
        reach = sizes.withColumn("_from", F.min("_no").over(near) - 1).select(
            *self.keys,
            F.col(CHUNK).alias("_into"),
            F.col("_first").alias("_opens"),
            F.explode(F.sequence(F.greatest("_from", F.lit(1)), F.greatest(F.col("_no") - 1, F.lit(1)))).alias("_no"),
            F.col("_no").alias("_own"),
        )
        reach = join_null_safe(
            reach.filter(F.col("_no") < F.col("_own")), sizes.select(*self.keys, "_no", CHUNK, "_end"), [*self.keys, "_no"]
        ).drop("_no", "_own")
        reach, _ = pin_small(reach)
        carried = [c for c in kept if c not in self.keys and c != CHUNK]
        borrowed = (
            join_null_safe(tails, reach, self.parts)
            .filter(F.col("_end") - F.col("_back") >= F.col("_opens") - n)
            .select(*self.keys, F.col("_into").alias(CHUNK), *carried, F.lit(True).alias(HALO))
        )
        own = self.rows.withColumn(HALO, F.lit(False))
        return self.with_rows(own.unionByName(borrowed, allowMissingColumns=True))

    def with_carry(self, **carries: tuple[Column, object, Column]) -> Series:
        """Add, for each row, a total over all earlier chunks of its series.

        Each carry is ``(aggregate of one chunk, function combining chunk values, value when
        there is no earlier chunk)``.
        """
        if not self.split:
            return self.with_rows(self.rows.withColumns({n: c[2] for n, c in carries.items()}))
        totals = (
            self.rows.filter(F.col(CHUNK).isNotNull())
            .groupBy(*self.parts)
            .agg(*[agg.alias(name) for name, (agg, _, _) in carries.items()])
        )
        # one row per chunk of a long series
        earlier = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select(
            *self.parts, *[combine(name).over(earlier).alias(name) for name, (_, combine, _) in carries.items()]
        )
        # known before the rows are read again, it joins them without another shuffle
        before, _ = pin_small(before)
        joined = join_null_safe(self.rows, before, self.parts, "left")
        return self.with_rows(
            joined.withColumns({n: F.coalesce(F.col(n), c[2]) for n, c in carries.items()})
        )


def split_series(
    df: DataFrame, keys: list[str], ts: str = "ts", sized_by: DataFrame | None = None
) -> Series:
    """Find the series that are too long for one task and assign their rows to chunks.

    Runs one count per key, on ``sized_by`` if given: a table with the same keys and timestamps
    and no fewer rows that is cheaper to read, such as the readings that ``df`` was derived
    from. The table of long series has at most ``rows / limit`` rows and is broadcast only
    if its checked size allows.
    """
    keys = list(keys)
    limit = series_rows(df)
    sized_by = df if sized_by is None else sized_by
    counts = sized_by.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot, n_hot = pin_small(counts.drop("_n"))
    if n_hot == 0:
        return Series(df, tuple(keys), False)

    second = epoch_seconds(df, ts)
    day, hour, minute, _ = (floor_div(F.col("_sec"), size) * size for size in CELLS)
    cells = [F.struct(cell.alias("at"), F.lit(i).alias("level")) for i, cell in enumerate((day, hour, minute))]
    # first summed up by minute; what is left are the cells with too many rows, few for each series
    dense = (
        join_null_safe(sized_by.select(*keys, epoch_seconds(sized_by, ts).alias("_sec")), hot, keys)
        .groupBy(*keys, minute.alias("_sec"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_n", F.explode(F.array(*cells)).alias("_cell"))
        .groupBy(*keys, "_cell")
        .agg(F.sum("_n").alias("_n"))
        .groupBy(*keys)
        .agg(
            F.collect_list(F.when(F.col("_n") > limit, F.col("_cell.at") * 4 + F.col("_cell.level"))).alias("_dense"),
            F.lit(True).alias("_hot"),
        )
    )
    dense, _ = pin_small(dense)
    too_many = [F.array_contains("_dense", cell * 4 + i) for i, cell in enumerate((day, hour, minute))]
    chunk = F.when(too_many[2], F.col("_sec")).when(too_many[1], minute).when(too_many[0], hour).otherwise(day)
    rows = (
        join_null_safe(df.withColumn("_sec", second), dense, keys, "left")
        .withColumn(CHUNK, F.when(F.col("_hot"), chunk))
        .drop("_sec", "_dense", "_hot")
    )
    return Series(rows, tuple(keys), True)
