"""Vocabulary numbers of changed terms, without sorting the vocabulary.

The number of a term is how many terms come before it: those of a greater count,
and those of the same count that are smaller. The index keeps how many terms there
are for each count and first letters (a cell). Signed changes of counts move terms between
cells. A term's number is the sum of the cells before its own, plus its place in
its cell; so only the cells of the terms that were asked for are sorted, each by
itself, in parallel.

The sums over cells are windows over one count's cells and over the distinct counts.
A corpus of N tokens has fewer than sqrt(2 N) distinct counts (5 million for 10^13
tokens), so that window's one task stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from termflow.session import delete_path, stored

#: First letters of a term that make its cell.
LETTERS = 4


class OrderIndex:
    """The terms of a corpus (``term, cnt``) and its cells (``cnt, head, n``)."""

    def __init__(self, terms: DataFrame, cells: DataFrame, paths: list[str], letters: int):
        self.terms, self.cells, self.paths, self.letters = terms, cells, paths, letters

    @classmethod
    def of(cls, counts: DataFrame, letters: int = LETTERS) -> OrderIndex:
        """The index of ``term, cnt`` rows (each term once, counts over 0)."""
        terms, a = stored(counts.select("term", F.col("cnt").cast("long").alias("cnt")), "order-terms")
        cells = terms.groupBy("cnt", F.substring("term", 1, letters).alias("head")).agg(F.count("*").alias("n"))
        cells, b = stored(cells, "order-cells")
        return cls(terms, cells, [a, b], letters)

    def changed_by(self, deltas: DataFrame) -> tuple[OrderIndex, DataFrame]:
        """The index after ``term, delta`` rows (several for a term add up), and the
        numbers of the terms that changed and are still there: ``term, cnt, number``.
        Counts that fall to 0 or under leave the index."""
        moved = deltas.groupBy("term").agg(F.sum("delta").alias("delta")).where("delta <> 0")
        moved = (moved.join(self.terms.withColumnRenamed("cnt", "was"), "term", "left")
                 .select("term", F.coalesce("was", F.lit(0)).alias("was"), (F.coalesce("was", F.lit(0)) + F.col("delta")).alias("cnt")))
        moved, path = stored(moved, "order-moved")
        kept = self.terms.join(moved.select("term"), "term", "left_anti")
        terms, a = stored(kept.unionByName(moved.where("cnt > 0").select("term", "cnt")), "order-terms")
        head = F.substring("term", 1, self.letters).alias("head")
        steps = (moved.where("was > 0").select(F.col("was").alias("cnt"), head, F.lit(-1).cast("long").alias("n"))
                 .unionByName(moved.where("cnt > 0").select("cnt", head, F.lit(1).cast("long").alias("n"))))
        cells, b = stored(self.cells.unionByName(steps).groupBy("cnt", "head").agg(F.sum("n").alias("n")).where("n <> 0"), "order-cells")
        index = OrderIndex(terms, cells, [a, b], self.letters)
        numbers = index.numbers(moved.where("cnt > 0").select("term", "cnt"))
        index.paths.append(path)
        return index, numbers

    def offsets(self) -> DataFrame:
        """``cnt, head, before``: how many terms come before each cell."""
        counts = self.cells.groupBy("cnt").agg(F.sum("n").alias("of_count"))
        above = Window.orderBy(F.desc("cnt")).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.select("cnt", F.coalesce(F.sum("of_count").over(above), F.lit(0)).alias("above"))
        left = Window.partitionBy("cnt").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
        cells = self.cells.select("cnt", "head", F.coalesce(F.sum("n").over(left), F.lit(0)).alias("left"))
        return cells.join(counts, "cnt").select("cnt", "head", (F.col("above") + F.col("left")).alias("before"))

    def numbers(self, asked: DataFrame) -> DataFrame:
        """``term, cnt, number`` of the terms asked for (``term, cnt`` as in the index)."""
        head = F.substring("term", 1, self.letters)
        cells = asked.select("cnt", head.alias("head")).distinct()
        # Only the members of the cells asked for are sorted, cell by cell.
        members = self.terms.withColumn("head", head).join(cells, ["cnt", "head"], "left_semi")
        place = F.row_number().over(Window.partitionBy("cnt", "head").orderBy("term")) - 1
        placed = members.withColumn("place", place).join(asked.select("term"), "term", "left_semi")
        return placed.join(self.offsets(), ["cnt", "head"]).select(
            "term", "cnt", (F.col("before") + F.col("place")).cast("long").alias("number"))

    def size(self) -> int:
        """How many terms there are."""
        return self.cells.agg(F.sum("n")).first()[0] or 0

    def delete(self) -> None:
        for p in self.paths:
            delete_path(self.terms.sparkSession, p)
