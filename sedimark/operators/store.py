"""State as a folder of append-only tables: what a pass changes is appended with a version, the latest row of a key counts.

No pass rewrites a table or reads more than it needs: plans don't grow from run to run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark import schemas
from sedimark.operators.ledger import latest
from sedimark.operators.runs import ITEM

#: Tables whose rows change, by their keys; of all others rows are only ever added.
CHANGING = {"job_posting": ["id"], "ingestion_item": list(ITEM), "ingestion_run": ["id"], "ingestion_attempt": [*ITEM, "attempt_no"]}
VERSION = "_version"

Tables = dict[str, DataFrame]


def empty(spark: SparkSession) -> Tables:
    return {name: schemas.empty(spark, name) for name in schemas.TABLES}


def applied(state: Tables, changes: Tables) -> Tables:
    """The state after changes, as plans over both."""
    out = dict(state)
    for name, rows in changes.items():
        old = out[name]
        if name in CHANGING:
            old = old.join(rows.select(*CHANGING[name]), CHANGING[name], "left_anti").select(rows.columns)
        out[name] = old.unionByName(rows)
    return out


class Store:
    """A folder that holds one Parquet table for each declared one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def has(self, name: str) -> bool:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(self._at(name))
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there)

    def missing(self) -> list[str]:
        return [name for name in schemas.TABLES if not self.has(name)]

    def create(self, name: str) -> None:
        self.append(name, schemas.empty(self.spark, name))

    def append(self, name: str, rows: DataFrame) -> None:
        """Adds rows under a version after all others; one append is one commit."""
        last = self.spark.read.parquet(self._at(name)).agg(F.max(VERSION)).first()[0] if self.has(name) else None
        want = [f.name for f in schemas.empty(self.spark, name).schema.fields]
        rows.select(*want).withColumn(VERSION, F.lit((last or 0) + 1).cast("long")).write.mode("append").parquet(self._at(name))

    def save(self, changes: Tables) -> None:
        """Appends all changes, in the order in which tables refer to each other."""
        for name in sorted(changes, key=list(schemas.TABLES).index):
            self.append(name, changes[name])

    def table(self, name: str) -> DataFrame:
        rows = self.spark.read.parquet(self._at(name))
        if VERSION not in rows.columns:  # written by something else
            return rows
        return (latest(rows, CHANGING[name], VERSION) if name in CHANGING else rows).drop(VERSION)

    def state(self) -> Tables:
        """All tables; those absent are errors, as an unmigrated store is."""
        if lost := self.missing():
            raise ValueError(f"table {lost[0]} is missing; migrate first")
        names = {name: [f.name for f in schemas.empty(self.spark, name).schema.fields] for name in schemas.TABLES}
        return {name: self.table(name).select(*names[name]) for name in schemas.TABLES}


def migrate(store: Store) -> list[str]:
    """Creates the tables of every migration that the store lacks and records it; a recorded one that has changed is an error.

    Returns the versions now applied.
    """
    applied_ = {r["version"]: r["checksum"] for r in store.table("schema_migration").collect()} if store.has("schema_migration") else {}
    done = []
    for version, names in schemas.MIGRATIONS.items():
        checksum = schemas.migration_checksum(version)
        if version in applied_:
            if applied_[version] != checksum:
                raise ValueError(f"migration {version} has changed since it was applied")
            continue
        for name in names:
            if not store.has(name):
                store.create(name)
        row = store.spark.range(1).select(F.lit(version).alias("version"), F.lit(checksum).alias("checksum"), F.current_timestamp().alias("applied_at"))
        store.append("schema_migration", row)
        done.append(version)
    return done


def counts(state: Tables) -> DataFrame:
    """(table, n) of every table of a state."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("table"), F.count("*").alias("n")) for name, df in state.items()])


def summary(state: Tables) -> dict:
    """Sizes of the tables that reports name, postings by source and observations by state."""
    n = {r["table"]: r["n"] for r in counts(state).collect()}
    names = {
        "postings": "job_posting", "revisions": "job_posting_revision", "raw_observations": "raw_observation", "organization_mentions": "organization_mention", "organization_candidates": "organization_candidate",
        "match_candidates": "match_candidate", "ingestion_runs": "ingestion_run", "ingestion_attempts": "ingestion_attempt", "ingestion_items": "ingestion_item",
    }
    grouped = lambda table, column: {r[0]: r[1] for r in state[table].groupBy(column).count().orderBy(column).collect()}
    return {k: n[t] for k, t in names.items()} | {"by_source": grouped("job_posting", "source_code"), "lifecycle": grouped("posting_lifecycle_observation", "state")}
