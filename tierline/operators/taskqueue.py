"""Task queue: one row per leaf key, with status transitions per run.

The queue is a DataFrame with a fixed schema.  Each transition is a
set-based step (anti join to insert unseen ids, left joins against
de-duplicated id sets to update), and a run stores the new state of the
seasons it touched once, which also cuts the lineage between runs.

Status precedence within one run: errored > completed > unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.ordering import INTERVAL, first_n
from tierline.schemas import COMPLETED, ERRORED, PENDING, TASK_KEYS, TASKS
from tierline.tables import files


def empty_queue(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TASKS)


def with_defaults(keys: DataFrame, now: Column | None = None,
                  status: Column | None = None) -> DataFrame:
    """Task rows from task keys: id = session id, status 0 (or ``status``),
    attempt 0, added now, never updated."""
    now = F.current_timestamp() if now is None else now
    status = F.lit(PENDING) if status is None else status
    return keys.select(
        F.col("session_id").alias("id"), *TASK_KEYS,
        status.cast("int").alias("status"), F.lit(0).alias("attempt"),
        now.alias("added_timestamp"),
        F.lit(None).cast("timestamp").alias("updated_timestamp"))


def new_tasks(queue: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` (task keys) whose id is not yet queued; duplicates
    inside the batch collapse to one row per id (the smallest keys)."""
    rest = [k for k in TASK_KEYS if k != "session_id"]
    unique = (batch.groupBy("session_id").agg(F.min(F.struct(*rest)).alias("_k"))
              .select("session_id", "_k.*"))
    unseen = unique.join(queue.select(F.col("id").alias("session_id")),
                         "session_id", "left_anti")
    return with_defaults(unseen)


def upsert(queue: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert-or-ignore: known ids keep their row, new ids are added."""
    return queue.select(*TASKS.names).unionByName(new_tasks(queue, batch))


def open_tasks(queue: DataFrame) -> DataFrame:
    return queue.filter(F.col("status") < COMPLETED)


def next_batch(queue: DataFrame, n: int | None = None) -> DataFrame:
    """Task keys of the first ``n`` open tasks by id, in that order if they
    are few; of all of them without ``n``."""
    todo = open_tasks(queue)
    if n is None:
        return todo.select(*TASK_KEYS)
    small = n <= INTERVAL
    return (todo.orderBy("id").limit(n) if small else first_n(todo, "id", n)).select(*TASK_KEYS)


def _flagged(queue: DataFrame, ids: DataFrame, on: Sequence[tuple[str, str]],
             flag: str) -> DataFrame:
    # Id columns get private names, so the join never sees two columns of
    # the same name, whatever the lineage of ``ids``.
    tmp = [f"{flag}_k{i}" for i in range(len(on))]
    hit = (ids.select(*[F.col(c).alias(t) for (_, c), t in zip(on, tmp)])
              .distinct().withColumn(flag, F.lit(True)))
    cond = None
    for (qcol, _), t in zip(on, tmp):
        c = F.col(qcol) == F.col(t)
        cond = c if cond is None else cond & c
    return queue.join(hit, cond, "left").drop(*tmp)


def mark(queue: DataFrame, ids: DataFrame, on: Sequence[tuple[str, str]],
         status: int, guard_not: int | None = None,
         now: Column | None = None) -> DataFrame:
    """Set ``status`` (and stamp the update time) on tasks matching ``ids``
    on the (task column, id column) pairs; with ``guard_not``, tasks
    already in that status are left alone.
    """
    now = F.current_timestamp() if now is None else now
    j = _flagged(queue, ids, on, "_hit")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if guard_not is not None:
        hit = hit & (F.col("status") != guard_not)
    return j.select(
        *[F.col(c) for c in TASKS.names if c not in ("status", "updated_timestamp")],
        F.when(hit, F.lit(status)).otherwise(F.col("status")).alias("status"),
        F.when(hit, now).otherwise(F.col("updated_timestamp")).alias("updated_timestamp"),
    ).select(*TASKS.names)


def mark_completed(queue: DataFrame, landed_session_ids: DataFrame) -> DataFrame:
    return mark(queue, landed_session_ids, [("id", "session_id")], COMPLETED,
                guard_not=COMPLETED)


def apply_run(queue: DataFrame, landed_session_ids: DataFrame,
              failed: dict[str, DataFrame], now: Column | None = None) -> DataFrame:
    """All transitions of a run in one pass over the queue.

    The two id sets keyed by session (landed, failed sessions) are merged
    into one flag table (partial aggregation, one shuffle join); the
    season, event and (event, category) sets are bounded by the hierarchy,
    so Spark broadcasts them by their size.
    """
    now = F.current_timestamp() if now is None else now
    by_session = (landed_session_ids.select("session_id", F.lit(1).alias("_done"),
                                            F.lit(0).alias("_err_s"))
                  .unionByName(failed["sessions"].select(
                      "session_id", F.lit(0).alias("_done"), F.lit(1).alias("_err_s")))
                  .groupBy("session_id")
                  .agg(F.max("_done").alias("_done"), F.max("_err_s").alias("_err_s")))
    q = queue.join(by_session, "session_id", "left")
    q = _flagged(q, failed["seasons"], [("season_id", "season_id")], "_err_a")
    q = _flagged(q, failed["events"], [("event_id", "event_id")], "_err_b")
    q = _flagged(q, failed["pairs"], [("event_id", "event_id"),
                                      ("category_id", "category_id")], "_err_c")
    err = (F.coalesce(F.col("_err_s"), F.lit(0)) == 1) | F.col("_err_a").isNotNull() \
        | F.col("_err_b").isNotNull() | F.col("_err_c").isNotNull()
    done = (F.coalesce(F.col("_done"), F.lit(0)) == 1) & (F.col("status") != COMPLETED)
    status = (F.when(err, F.lit(ERRORED)).when(done, F.lit(COMPLETED))
               .otherwise(F.col("status")))
    updated = F.when(err | done, now).otherwise(F.col("updated_timestamp"))
    return q.select(
        *[F.col(c) for c in TASKS.names if c not in ("status", "updated_timestamp")],
        status.alias("status"), updated.alias("updated_timestamp")).select(*TASKS.names)


def without_clocks(queue: DataFrame) -> DataFrame:
    """Queue rows with the clock columns replaced by ``has_updated``."""
    return queue.select("id", "season_id", "event_id", "category_id", "session_id",
                        "status", "attempt",
                        F.col("updated_timestamp").isNotNull().alias("has_updated"))


class TaskQueue:
    """A queue stored as Parquet, partitioned by season.

    A save replaces the seasons it names, in one write, so a run costs its
    seasons, not the whole queue.  Rows of a season lie by status, so the row
    groups of a long queue that hold nothing open are not read for the next
    batch.  A writer that dies while its folders are put in place can leave a
    season without tasks; such tasks are queued again, as unseen ones.  Season
    ids come to the driver; they are bounded by the season dimension.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def seasons(self) -> list[str]:
        return self.seasons_of(self.state())

    def state(self, seasons: Sequence[str] | None = None) -> DataFrame:
        """Tasks of the given seasons (all seasons when None)."""
        if seasons is not None and not seasons or not files.exists(self.spark, self.location):
            return empty_queue(self.spark)
        tasks = self.spark.read.schema(TASKS).parquet(self.location).select(*TASKS.names)
        return tasks if seasons is None else tasks.filter(F.col("season_id").isin(sorted(seasons)))

    def save(self, df: DataFrame, seasons: Sequence[str]) -> None:
        """Store ``df`` as the rows of ``seasons`` (and of nothing else)."""
        if not seasons:
            return
        rows = df.select(*TASKS.names).filter(F.col("season_id").isin(sorted(seasons)))
        (rows.hint("rebalance", "season_id").sortWithinPartitions("season_id", "status", "id")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("season_id").parquet(self.location))

    @staticmethod
    def seasons_of(df: DataFrame) -> list[str]:
        return sorted(r[0] for r in df.select("season_id").distinct().collect())

    def upsert(self, batch: DataFrame) -> DataFrame:
        seasons = self.seasons_of(batch)
        self.save(upsert(self.state(seasons), batch), seasons)
        return self.state()

    def next_batch(self, n: int | None = None) -> DataFrame:
        return next_batch(self.state(), n)

    def apply_run(self, landed_session_ids: DataFrame, failed: dict[str, DataFrame],
                  seasons: Sequence[str] | None = None) -> DataFrame:
        """Transitions of a run over the seasons it touched (all when None)."""
        seasons = self.seasons() if seasons is None else list(seasons)
        self.save(apply_run(self.state(seasons), landed_session_ids, failed), seasons)
        return self.state()
