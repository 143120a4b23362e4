"""Term counts of a corpus that grows, is replayed and loses batches, without
reading the corpus again.

A state folder holds one small table of signed counts for each batch that came
(``add=<n>``) or was withdrawn (``withdraw=<n>``), and a merged base
(``base=<m>``) of all entries up to a batch. The counts of the corpus are one sum over
the base and what came after it. An entry is whole once Spark's ``_SUCCESS`` is there;
unfinished ones are never read and are written anew by the replay. A base
becomes current with its settings, written last; the one before stays until then.

Defined results: a batch that was added, and one that was withdrawn, is not counted again
by a replay; withdrawing a batch that never came, or whose entry was forgotten, is an error;
terms whose counts sum to 0 are not in the corpus; null terms are not counted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from termflow.session import delete_path, hadoop_fs, hadoop_path, path_exists

SCHEMA = "term string, delta long"


def within(batch: int, spans: list[list[int]]) -> bool:
    return any(a <= batch <= z for a, z in spans)


def ranges(batches: list[int], spans: list[list[int]]) -> list[list[int]]:
    """The spans of batch numbers with some more of them: as few as there are gaps."""
    out: list[list[int]] = []
    for a, z in sorted([*map(list, spans), *[[b, b] for b in batches]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


class CountState:
    """The counts of a corpus in the folder ``path`` (one writer at a time)."""

    def __init__(self, spark: SparkSession, path: str, merge_every: int = 0):
        #: Entries after the base that start a merge; 0: only when asked.
        self.spark, self.path, self.merge_every = spark, path.rstrip("/"), merge_every

    # -- entries ---------------------------------------------------------------

    def _entries(self, kind: str) -> list[int]:
        """The numbers of the whole entries of a kind, ascending."""
        if not path_exists(self.spark, self.path):
            return []
        names = [s.getPath().getName() for s in hadoop_fs(self.spark, self.path).listStatus(hadoop_path(self.spark, self.path))]
        numbers = sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))
        mark = "settings/_SUCCESS" if kind == "base" else "_SUCCESS"
        return [n for n in numbers if path_exists(self.spark, f"{self.path}/{kind}={n}/{mark}")]

    def _base(self) -> dict:
        bases = self._entries("base")
        if not bases:
            return {"number": 0, "added": [], "withdrawn": []}
        row = self.spark.read.text(f"{self.path}/base={bases[-1]}/settings").first()
        return {"number": bases[-1], **json.loads(row.value)}

    def _is_in(self, kind: str, batch: int, base: dict) -> bool:
        merged = base["added" if kind == "add" else "withdrawn"]
        return within(batch, merged) or path_exists(self.spark, f"{self.path}/{kind}={batch}/_SUCCESS")

    def add(self, batch: int, terms: DataFrame) -> None:
        """Count the ``term`` rows of a batch; a replay changes nothing."""
        base = self._base()
        if not self._is_in("add", batch, base):
            counts = terms.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("delta"))
            counts.write.mode("overwrite").parquet(f"{self.path}/add={batch}")
        self._merge_if_due()

    def withdraw(self, batch: int) -> None:
        """Take a batch out of the corpus again."""
        base = self._base()
        if self._is_in("withdraw", batch, base):
            return
        there = f"{self.path}/add={batch}"
        if not path_exists(self.spark, f"{there}/_SUCCESS"):
            raise KeyError(f"batch {batch} never came, or its counts were forgotten")
        gone = self.spark.read.schema(SCHEMA).parquet(there).select("term", (-F.col("delta")).alias("delta"))
        gone.write.mode("overwrite").parquet(f"{self.path}/withdraw={batch}")
        self._merge_if_due()

    # -- reading ---------------------------------------------------------------

    def _open(self, base: dict) -> list[str]:
        """Folders of the entries that are not in the base."""
        return [f"{self.path}/{kind}={b}" for kind, merged in (("add", base["added"]), ("withdraw", base["withdrawn"]))
                for b in self._entries(kind) if not within(b, merged)]

    def deltas(self) -> DataFrame:
        """``term, delta``: the base and every entry after it."""
        base = self._base()
        folders = ([f"{self.path}/base={base['number']}/counts"] if base["number"] else []) + self._open(base)
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*folders)

    def counts(self) -> DataFrame:
        """``term, cnt`` of the corpus as it is now."""
        return (self.deltas().groupBy("term").agg(F.sum("delta").alias("cnt")).where("cnt <> 0"))

    # -- merging ---------------------------------------------------------------

    def _merge_if_due(self) -> None:
        if self.merge_every and len(self._open(self._base())) >= self.merge_every:
            self.merge()

    def merge(self) -> None:
        """Sum everything to a new base. Entries stay, so that their batches can be
        withdrawn later (:meth:`forget`)."""
        base = self._base()
        if not self._open(base):
            return
        settings = {"added": ranges(self._entries("add"), base["added"]), "withdrawn": ranges(self._entries("withdraw"), base["withdrawn"])}
        here = f"{self.path}/base={base['number'] + 1}"
        self.counts().withColumnRenamed("cnt", "delta").write.mode("overwrite").parquet(f"{here}/counts")
        self.spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode("overwrite").text(f"{here}/settings")
        if base["number"]:
            delete_path(self.spark, f"{self.path}/base={base['number']}")

    def forget(self, upto: int) -> None:
        """Delete the entries of merged batches up to ``upto``, which then cannot be
        withdrawn any more."""
        base = self._base()
        for b in self._entries("add"):
            if b <= upto and within(b, base["added"]):
                delete_path(self.spark, f"{self.path}/add={b}")
                if within(b, base["withdrawn"]):
                    delete_path(self.spark, f"{self.path}/withdraw={b}")
