"""The newest answer of each request, kept in a table that runs join without moving or grouping its bodies."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cleanroll.session import delete_path

KEY = "request_key"
KEPT = 2  # generations: a run that still reads the one before the newest is not disturbed


@dataclass(frozen=True)
class CurrentAnswers:
    """One table a provider, `(request_key, fetched_at, body)` with a row a key, bucketed by the key.

    `fold` merges newly landed answers in: the new ones, few beside the table, are sent to the buckets, the table's own
    bodies stay in theirs. Each fold writes a new generation below `root` and registers it in the session's catalog, so
    that an interrupted fold leaves the one before in place; folding the same answers again changes nothing. A lookup
    hashes the keys of a run, one bucket's share at a time, and streams the buckets past them: no body is shuffled or
    sorted. Choose `buckets` so that a bucket's share of a run's keys fits in a task.
    """

    spark: SparkSession
    name: str
    root: str
    buckets: int = 200

    def _generations(self, provider: str) -> list[tuple[int, str]]:
        """(number, table) of the provider's generations, oldest first."""
        prefix = f"{self.name}_{provider}_g"
        names = [t.name for t in self.spark.catalog.listTables(pattern=f"{prefix}*") if t.name.startswith(prefix)]
        return sorted((int(n[len(prefix) :].split("_")[0]), n) for n in names)

    def table(self, provider: str) -> DataFrame:
        """The provider's current answers; an error if none were folded in."""
        generations = self._generations(provider)
        if not generations:
            raise ValueError(f"no answers of {provider} were folded into {self.name}")
        return self.spark.table(generations[-1][1])

    def fold(self, landed: DataFrame, provider: str, fetched_since=None) -> None:
        """Merge the provider's good answers of `landed`, those since `fetched_since` if it is given.

        Of several answers to a key the newest stays; of equal times the greatest body.
        """
        generations = self._generations(provider)
        merged = self.merged(landed, provider, fetched_since)
        number = generations[-1][0] + 1 if generations else 0
        name = f"{self.name}_{provider}_g{number}_{uuid.uuid4().hex[:8]}"
        merged.write.bucketBy(self.buckets, KEY).option("path", f"{self.root}/{name}").option("compression", "zstd").saveAsTable(name)
        for _, old in generations[: len(generations) + 1 - KEPT]:
            self.spark.sql(f"DROP TABLE IF EXISTS {old}")
            delete_path(self.spark, f"{self.root}/{old}")

    def merged(self, landed: DataFrame, provider: str, fetched_since=None) -> DataFrame:
        """The table that `fold` writes. The new answers are sent to the buckets, as many as there are: with another number
        of partitions than that, the join would send the whole table to theirs."""
        from cleanroll.sources.answers import good_answers, newest

        fresh = newest(good_answers(landed, provider, fetched_since).where(F.col(KEY).isNotNull())).repartition(self.buckets, KEY)
        generations = self._generations(provider)
        if not generations:
            return fresh
        current = self.spark.table(generations[-1][1]).select(KEY, F.struct("fetched_at", "body").alias("old"))
        new = fresh.select(KEY, F.struct("fetched_at", "body").alias("new")).hint("shuffle_hash")
        return current.join(new, KEY, "full_outer").select(KEY, F.greatest("old", "new").alias("a")).select(KEY, "a.fetched_at", "a.body")

    def answers(self, keys: DataFrame, provider: str, fetched_since=None) -> DataFrame:
        """`keys` plus `fetched_at, body` of those with an answer, fetched since `fetched_since` if it is given."""
        current = self.table(provider)
        if fetched_since is not None:
            current = current.where(F.col("fetched_at") >= F.lit(fetched_since).cast(current.schema["fetched_at"].dataType))
        return current.join(keys.hint("shuffle_hash"), KEY).select(*keys.columns, "fetched_at", "body")
