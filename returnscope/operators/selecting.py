"""Exact order statistics by counting, without a sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cells into which an interval is cut in each pass.
CELLS = 1_024


def order_statistics(df: DataFrame, wanted: Mapping[str, Sequence[int]], extremes: Mapping[str, tuple[float, float]]) -> dict[tuple[str, int], float]:
    """The values of the given ranks, counted from 0 without nulls, for several columns at once.

    ``extremes`` are the columns' smallest and largest values. Every rank lies in an interval, at first
    from one extreme to the other. A pass cuts all open intervals of all columns into cells, counts the
    rows of each cell and notes its extremes, and each rank goes on with the cell that holds it, until
    that is a single value. Passes thus divide an interval by ``CELLS`` or more and don't depend on the
    number of columns; what the driver reads is ``CELLS`` rows a rank at most, whatever the table.
    """
    spark, found = df.sparkSession, {}
    # (column, rank): interval, and how many rows lie before it.
    open_ = {(c, r): (*extremes[c], 0) for c, ranks in wanted.items() for r in ranks}
    while True:
        found |= {key: low for key, (low, high, _) in open_.items() if low == high}
        open_ = {key: state for key, state in open_.items() if key not in found}
        if not open_:
            return found
        # Ranks that share an interval are counted once.
        spans = sorted({(c, low, high) for (c, _), (low, high, _) in open_.items()})
        number = {span: n for n, span in enumerate(spans)}
        rows = [(n, c, low, high) for (c, low, high), n in number.items()]
        intervals = F.broadcast(spark.createDataFrame(rows, "span int, name string, low double, high double"))
        columns = list(dict.fromkeys(c for c, _, _ in spans))
        melted = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])))
        value, low, high = F.col("value"), F.col("low"), F.col("high")
        # Halves, so that no width overflows; beside an infinite end, everything between the ends is one cell.
        width = high / 2 - low / 2
        share = F.when(width < float("inf"), F.try_divide(value / 2 - low / 2, width))
        place = F.coalesce(F.floor(share * CELLS), F.lit(CELLS // 2))
        cell = F.when(value == low, -1).when(value == high, CELLS + 1).otherwise(F.least(F.greatest(place, F.lit(0)), F.lit(CELLS)))
        counted = (
            melted.filter("value IS NOT NULL")
            .join(intervals, "name")
            .filter((value >= low) & (value <= high))
            .groupBy("span", cell.alias("cell"))
            .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
            .collect()
        )
        cells: dict[int, list] = {n: [] for n in number.values()}
        for r in sorted(counted, key=lambda r: r["cell"]):
            cells[r["span"]].append(r)
        for (c, rank), (start, end, before) in open_.items():
            for r in cells[number[c, start, end]]:
                if rank < before + r["n"]:
                    open_[c, rank] = (r["least"], r["most"], before)
                    break
                before += r["n"]
