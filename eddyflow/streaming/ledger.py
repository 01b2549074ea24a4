"""Ledgers: what each micro-batch added, safe across restarts and kept short.

A batch writes its rows into a folder of its own,
``<path>/<owner>=.../run=.../batch_id=...``.  ``run`` is the identity of the
streaming query, which Spark keeps in its checkpoint: a batch that runs again
after a failure replaces its rows, while a new checkpoint, whose batch ids start
at 0 again, writes beside those of the earlier runs.

Folding adds up the rows of finished batches into a part of the base
(``<path>/_parts/<owner>/part=N``).  Parts lie in tiers: a fold makes a part of
tier 0, and where a tier has ``TIER_PARTS`` of them they become, in the same
write, one part of the next tier.  A row is thus rewritten once a tier, and what a
fold writes grows with its own keys, not with all keys ever stored.  A version
(``<path>/_base/<owner>/v=N``: the parts that count, and the last batch folded of each run) is written
after its part; readers take the newest complete version and the batches after it.
What neither the newest version nor the one before it names is removed, so whoever
still reads that one finds what it planned; the number of folders stays within two
foldings and the parts of the tiers.

Parts are sorted by key and carry Bloom filters: a predicate on the keys
(``find``) reaches the scan and skips the row groups that cannot hold them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exactsum import UNITS_TYPE
from ..sinks.tables import overwrite_partitions
from ..storage import drop_folder, exists, folder_names

FOLD_EVERY = 20
DIRECT_RUN = "direct"  # rows written outside a streaming query
COVERS_SCHEMA = "run string, upto bigint"
VERSION_SCHEMA = f"{COVERS_SCHEMA}, part bigint, tier int"  # a row per run and a row per part
TIER_PARTS = 4  # parts of one tier that become one of the next
ROW_GROUP_BYTES = 16 << 20


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query whose batch this is."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT_RUN


@dataclass(frozen=True)
class Ledger:
    """``keys`` and ``value`` with their types; rows of equal keys are folded by
    ``how`` (``sum`` or ``max``); ``owner`` is the column that tells jobs apart.
    With ``per_run`` rows of different runs are never folded together."""

    path: str
    keys: tuple[tuple[str, str], ...]
    value: tuple[str, str]
    how: str
    owner: str
    per_run: bool = False

    @property
    def names(self) -> list[str]:
        return [k for k, _ in self.keys]

    @property
    def schema(self) -> str:
        return ", ".join(f"{n} {t}" for n, t in (*self.keys, self.value, (self.owner, "string"), ("run", "string"),
                                                 ("batch_id", "bigint")))

    def write(self, rows: DataFrame, owner: str, run: str, batch_id: int) -> None:
        tagged = (rows.select(*self.names, self.value[0]).withColumn(self.owner, F.lit(owner))
                  .withColumn("run", F.lit(run)).withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        overwrite_partitions(tagged, self.path, [self.owner, "run", "batch_id"])

    # -- versions of the base

    def _base(self, owner: str) -> str:
        return f"{self.path}/_base/{owner}"

    def _versions(self, spark: SparkSession, owner: str) -> list[int]:
        """Complete versions, ascending: ``covers`` is written last."""
        found = sorted(int(n.removeprefix("v=")) for n in folder_names(spark, self._base(owner)) if n.startswith("v="))
        return [v for v in found if exists(spark, f"{self._base(owner)}/v={v}/covers/_SUCCESS")]

    def covers(self, spark: SparkSession, owner: str) -> DataFrame:
        """``run, upto``: the last batch of each run that the base holds."""
        versions = self._versions(spark, owner)
        if not versions:
            return spark.createDataFrame([], COVERS_SCHEMA)
        return self._version(spark, owner, versions[-1]).where("run is not null").select("run", "upto")

    def _version(self, spark: SparkSession, owner: str, version: int) -> DataFrame:
        return spark.read.schema(VERSION_SCHEMA).parquet(f"{self._base(owner)}/v={version}/covers")

    def _part(self, owner: str, part: int) -> str:
        return f"{self.path}/_parts/{owner}/part={part}"

    def parts(self, spark: SparkSession, owner: str) -> dict[int, int]:
        """Tier of each part (a few a tier) of the newest version."""
        versions = self._versions(spark, owner)
        if not versions:
            return {}
        named = self._version(spark, owner, versions[-1]).where("part is not null")
        return {r["part"]: r["tier"] for r in named.collect()}

    def part_rows(self, spark: SparkSession, owner: str, parts: Iterable[int]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*[self._part(owner, p) for p in sorted(parts)])

    def _owners(self, spark: SparkSession) -> list[str]:
        live = [n.split("=", 1)[1] for n in folder_names(spark, self.path) if n.startswith(f"{self.owner}=")]
        return sorted({*live, *folder_names(spark, f"{self.path}/_base")})

    # -- reading

    def batches(self, spark: SparkSession, owner: str) -> DataFrame:
        """Rows of the batches that are not folded yet."""
        where = f"{self.path}/{self.owner}={owner}"
        if not exists(spark, where):
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).option("basePath", self.path).parquet(where)
        covered = self.covers(spark, owner).select(F.col("run").alias("c_run"), "upto")
        return rows.join(covered, (F.col("run") == F.col("c_run")) & (F.col("batch_id") <= F.col("upto")), "left_anti")

    def read(self, spark: SparkSession, owner: str | None = None, committed: DataFrame | None = None) -> DataFrame:
        """All rows, folded or not (``batch_id`` -1 where folded).  With
        ``committed`` (``run, upto``) only batches up to there count."""
        if owner is None:
            parts = [self.read(spark, o, committed) for o in self._owners(spark)]
            out = spark.createDataFrame([], self.schema)
            for p in parts:
                out = out.unionByName(p)
            return out
        rows = self.batches(spark, owner)
        if committed is not None:
            done = committed.select(F.col("run").alias("d_run"), F.col("upto").alias("d_upto"))
            rows = rows.join(done, (F.col("run") == F.col("d_run")) & (F.col("batch_id") <= F.col("d_upto")),
                             "left_semi")
        parts = self.parts(spark, owner)
        return rows.unionByName(self.part_rows(spark, owner, parts)) if parts else rows

    def find(self, spark: SparkSession, owner: str, wanted: Column) -> DataFrame:
        """Values of the keys for which ``wanted``, a predicate on key columns,
        holds; only row groups that may have such keys are read."""
        return self.folded(self.read(spark, owner).where(wanted))

    def folded(self, rows: DataFrame) -> DataFrame:
        keys = [*self.names, *(["run"] if self.per_run else [])]
        total = {"sum": F.sum, "max": F.max}[self.how](self.value[0]).cast(self.value[1])
        return rows.groupBy(*keys).agg(total.alias(self.value[0]))

    def positions(self, spark: SparkSession, owner: str) -> DataFrame:
        """``run, upto``: the last batch of each run that has rows here."""
        seen = self.batches(spark, owner).select("run", F.col("batch_id").alias("upto"))
        return seen.unionByName(self.covers(spark, owner)).groupBy("run").agg(F.max("upto").alias("upto"))

    # -- folding

    def fold(self, spark: SparkSession, owner: str, run: str, upto: int) -> None:
        """Move the batches of ``run`` up to ``upto``, all finished, into the
        base.  Running it again changes nothing."""
        versions = self._versions(spark, owner)
        new = versions[-1] + 1 if versions else 0
        before = self.parts(spark, owner)
        # One row per checkpoint ever used.
        covered = {r["run"]: r["upto"] for r in self.covers(spark, owner).collect()}
        tier, merged = 0, []
        while len(full := [p for p, t in before.items() if t == tier]) + 1 >= TIER_PARTS:
            merged += full
            tier += 1
        rows = self.batches(spark, owner).where((F.col("run") == run) & (F.col("batch_id") <= upto))
        if merged:
            rows = rows.unionByName(self.part_rows(spark, owner, merged))
        self._write_part(self.folded(rows), owner, new)
        kept = {p: t for p, t in before.items() if p not in merged} | {new: tier}
        now = covered | {run: max(upto, covered.get(run, upto))}
        version = [(r, u, None, None) for r, u in now.items()] + [(None, None, p, t) for p, t in kept.items()]
        (spark.createDataFrame(version, VERSION_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{self._base(owner)}/v={new}/covers"))
        if versions:
            self._drop(spark, owner, versions, covered, set(before) | set(kept))

    def _write_part(self, rows: DataFrame, owner: str, part: int) -> None:
        """A part of a fold that died has the same number and is replaced."""
        if not self.per_run:
            rows = rows.withColumn("run", F.lit(None).cast("string"))
        rows = rows.withColumn(self.owner, F.lit(owner)).withColumn("batch_id", F.lit(-1).cast("bigint"))
        writer = (rows.sortWithinPartitions(*self.names).write.mode("overwrite")
                  .option("parquet.block.size", ROW_GROUP_BYTES)
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
        for name, kind in self.keys:
            if kind == "string":
                writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(self._part(owner, part))

    def _drop(self, spark: SparkSession, owner: str, versions: list[int], covered: dict[str, int],
              named: set[int]) -> None:
        """Folders of batches that the last version before the newest covers, older
        versions, and parts that neither of the two names."""
        for run, upto in covered.items():
            where = f"{self.path}/{self.owner}={owner}/run={run}"
            for name in folder_names(spark, where):
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= upto:
                    drop_folder(spark, f"{where}/{name}")
        for v in versions[:-1]:
            drop_folder(spark, f"{self._base(owner)}/v={v}")
        for name in folder_names(spark, f"{self.path}/_parts/{owner}"):
            if int(name.removeprefix("part=")) not in named:
                drop_folder(spark, self._part(owner, int(name.removeprefix("part="))))


def metric_ledger(path: str) -> Ledger:
    """Parts of exact sums per metric and key (``functions.exactsum``)."""
    return Ledger(path, (("metric", "string"), ("key", "string"), ("exponent", "int")), ("units", UNITS_TYPE), "sum",
                  "query")


def offset_ledger(path: str) -> Ledger:
    return Ledger(path, (("topic", "string"), ("partitioner", "int")), ("offset", "bigint"), "max", "groupid")


def running_ledger(path: str) -> Ledger:
    """Totals per word of one state store: they only grow, so a run's last
    total is its largest; runs are added up."""
    return Ledger(path, (("word", "string"),), ("cnt", "bigint"), "max", "job", per_run=True)


def per_batch_ledger(path: str, keys: tuple[tuple[str, str], ...] = ()) -> Ledger:
    """Counts of each batch on its own, or with ``keys`` partial counts."""
    return Ledger(path, (*keys, ("word", "string")), ("cnt", "bigint"), "sum", "job")


def fold_now_and_then(ledgers: list[Ledger], spark: SparkSession, owner: str, run: str, batch_id: int,
                      every: int = FOLD_EVERY) -> None:
    """After batch ``batch_id``: fold all but it whenever ``every`` are due."""
    if every and batch_id and batch_id % every == 0:
        for x in ledgers:
            x.fold(spark, owner, run, batch_id - 1)
