"""Stored per-user state: one row per user and fact, bucketed by user, merged with batches and joined without a shuffle.

Everything the user-level tables need is kept per user in a form that merges: first and last event times, the earliest cancellation and match, the number of
tickets inside the window. A user who owns a large share of the log is one row here, so buckets are even. The five tables are stored bucketed and sorted
by ``user_id`` and registered as tables; their joins need no exchange. A batch of new facts is reduced to one row per user and merged with the
stored state: a pass over users, not over the log. Each refresh writes new tables beside the old ones and ends by naming
the new generation, one rename, so that readers and a dead driver see one or the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from liftline.operators import user_metrics as um
from liftline.operators.events import milestones
from liftline.params import Experiment
from liftline.schemas import TABLES
from liftline.sources.journal import Folders

FIRST, LAST = "onboarding_started_ts onboarding_completed_ts first_booking_ts".split(), ["last_open_ts"]
#: State tables and how two rows of a user become one; users are replaced by newer rows.
MERGES = {
    "milestones": {**dict.fromkeys(FIRST, F.min), **dict.fromkeys(LAST, F.max)},
    "cancellations": {"cancelled_ts": F.min},
    "matches": {"matched_ts": F.min},
    "tickets": {"_tickets": F.sum},
}
GENERATIONS = "_generations"


def _states(users: DataFrame, batch: dict[str, DataFrame], exp: Experiment) -> dict[str, DataFrame]:
    """The states of the facts of a batch; ``users`` has everybody a ticket may belong to."""
    out = {}
    if "fact_events" in batch:
        out["milestones"] = milestones(batch["fact_events"], exp.names)
    if "fact_cancellations" in batch:
        out["cancellations"] = um.first_per_user(batch["fact_cancellations"], "cancelled_ts")
    if "fact_matches" in batch:
        out["matches"] = um.first_per_user(batch["fact_matches"], "matched_ts")
    if "fact_support_tickets" in batch:
        out["tickets"] = um.count_after_signup(users, batch["fact_support_tickets"], "created_ts", exp.windows.tickets, "_tickets")
    return out


class Star:
    """The stored state under one folder."""

    def __init__(self, spark: SparkSession, root: str, name: str = "star", buckets: int = 32, exp: Experiment = Experiment()):
        self.spark, self.root, self.name, self.buckets, self.exp = spark, root.rstrip("/"), name, buckets, exp
        self.folders = Folders(spark, root)

    def _generation(self) -> int:
        return max([int(x) for x in self.folders.names(GENERATIONS) if x.isdigit()], default=0)

    def _store(self, table: str, df: DataFrame, generation: int) -> None:
        name = f"{self.name}_{table}_{generation}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        path = f"{table}/{generation}"
        self.folders.delete(path)  # of a refresh that died before its generation was named
        dealt = df.repartition(self.buckets, "user_id")
        dealt.write.bucketBy(self.buckets, "user_id").sortBy("user_id").option("path", f"{self.root}/{path}").saveAsTable(name)

    def read(self, table: str) -> DataFrame:
        """A state table of the current generation; a session that does not know it yet registers it from its files."""
        generation = self._generation()
        name = f"{self.name}_{table}_{generation}"
        if not self.spark.catalog.tableExists(name):
            path = f"{self.root}/{table}/{generation}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (user_id) SORTED BY (user_id) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(name)

    def _turn(self, generation: int) -> None:
        """Name a whole generation as the current one, by one rename; the one before last goes."""
        self.folders.write(f"{GENERATIONS}/{generation:08d}", "")
        if generation > 2:
            self.folders.delete(f"{GENERATIONS}/{generation - 2:08d}")
            for table in ("users", *MERGES):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}_{generation - 2}")
                self.folders.delete(f"{table}/{generation - 2}")

    def build(self, tables: dict[str, DataFrame]) -> None:
        """All state from whole tables."""
        generation, users = self._generation() + 1, tables["dim_users"]
        self._store("users", users.select(*TABLES["dim_users"].schema.fieldNames()), generation)
        for table, df in _states(users, tables, self.exp).items():
            self._store(table, df, generation)
        self._turn(generation)

    def refresh(self, batch: dict[str, DataFrame]) -> None:
        """Merge a batch of new facts, and of new users or users whose signup stays as it was.

        A count of tickets was taken from the signup it was told: a batch that moves the signup of a known user is refused, rebuild then.
        """
        generation, users = self._generation(), self.read("users")
        if "dim_users" in batch:
            incoming = batch["dim_users"].select(*users.columns)
            moved = users.join(incoming.select("user_id", F.col("signup_ts").alias("_new")), "user_id").where("NOT signup_ts <=> _new")
            n = moved.count()
            if n:
                raise ValueError(f"{n} users signed up at another time than stored: rebuild")
            users = users.join(incoming.select("user_id"), "user_id", "left_anti").unionByName(incoming)
        fresh = _states(users, batch, self.exp)
        self._store("users", users, generation + 1)
        for table, merges in MERGES.items():
            state = self.read(table)
            if table in fresh:
                both = state.unionByName(fresh[table].select(*state.columns))
                state = both.groupBy("user_id").agg(*[how(c).alias(c) for c, how in merges.items()])
            self._store(table, state, generation + 1)
        self._turn(generation + 1)

    def user_facts(self) -> DataFrame:
        """One row per user with all outcomes; every join finds both sides bucketed."""
        w = self.exp.windows
        base = self.read("users")
        for table in MERGES:
            base = base.join(self.read(table), "user_id", "left")
        return base.withColumns({
            "activated_within_7d": um.activated(w.activation),
            "retained_d7": um.retained(w.retention_short),
            "retained_d30": um.retained(w.retention_long),
            "cancelled_30d": um.cancelled(w.cancellation),
            "time_to_first_match_hours": um.hours_to_match(),
            "support_tickets_30d": F.coalesce("_tickets", F.lit(0).cast("long")),
        })

    def experiment_user_metrics(self) -> DataFrame:
        return self.user_facts().select(*um.USER_COLUMNS, *um.OUTCOME_COLUMNS)
