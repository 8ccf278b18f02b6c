"""The stored tables and how they are laid out.

Tables keyed within a match are hash-bucketed by ``match_id``. Every scorecard groups,
joins or windows within a match, so it runs on the buckets without moving a row, and a filter
on one match opens one bucket. The hash also spreads a crowded season or team evenly, and a
match is never larger than its document, so no bucket can run hot.

``part`` is the number of the bucket, used as the directory level, so that an upsert rewrites a
bucket and nothing beside it.

Tables that a build replaces as a whole, the dimensions, have ``PLACES`` places that take turns, and a
note says which ones hold the current rows. It is written last and for all of them together: a reader
sees the old dimensions or the new ones, and one that began before goes on reading the old ones until
their places come round again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease import schemas
from crease.session import shared_folder

#: Places of a table that is replaced as a whole: what was read stays for so many builds, less one.
PLACES = 3

#: Directories of the tables of warehouses made before each bucket had its own.
FORMER_PARTS = 256

# Some 200 MB of the fact, and a count that Spark still accepts.
BALLS_PER_BUCKET = 5_000_000
MOST_BUCKETS = 65_536


def buckets_for(balls: int, cores: int) -> int:
    """A bucket count for an expected number of balls, at least one for each core."""
    return min(max(cores, -(-balls // BALLS_PER_BUCKET)), MOST_BUCKETS)


@dataclass(frozen=True)
class Layout:
    columns: list[tuple[str, str]]
    bucket_sort: tuple[str, ...] = ()
    partitions: tuple[tuple[str, str], ...] = ()


BY_PART = (("part", "int"),)

LAYOUTS = {
    "raw_match_json": Layout(
        [
            ("match_id", "string"),
            ("file_name", "string"),
            ("raw_variant", "variant"),
            ("loaded_at", "timestamp_ntz"),
            ("info", "variant"),
            ("reason", "string"),
        ],
        partitions=(("load_id", "string"), ("accepted", "boolean")),
    ),
    "match_header": Layout(schemas.HEADER_COLUMNS, ("match_id",), BY_PART),
    "fact_ball": Layout(
        schemas.FACT_BALL_COLUMNS, ("match_id", "innings_no", "over_no", "ball_in_over"), BY_PART
    ),
    "dim_team": Layout(schemas.DIM_TEAM_COLUMNS),
    "dim_player": Layout(schemas.DIM_PLAYER_COLUMNS),
    "dim_player_team": Layout(schemas.DIM_PLAYER_TEAM_COLUMNS, ("match_id",)),
    "dim_season": Layout(schemas.DIM_SEASON_COLUMNS),
}
# An upsert parks its rows in tables laid out like its target.
for _target in ("match_header", "fact_ball"):
    for _stage in ("arrivals", "rewrite"):
        LAYOUTS[f"{_target}_{_stage}"] = LAYOUTS[_target]


def _at(table: str, number: int) -> str:
    """The place of a table's rows as they were replaced for the n-th time."""
    place = number % PLACES
    return f"{table}_{place}" if place else table


PUBLISHED = [table for table, layout in LAYOUTS.items() if not layout.partitions]
for _table in PUBLISHED:
    LAYOUTS.update({_at(_table, _place): LAYOUTS[_table] for _place in range(PLACES)})


class Warehouse:
    """A database of the tables above in the cluster's shared folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        database: str = "crease",
        buckets: int | None = None,
    ):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/{database}"
        self.database = database
        self.buckets, self.parts = self._settle_buckets(buckets)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/tables'")
        self._declared: set[str] = set()
        self._read: dict[str, int] = {}

    def _settle_buckets(self, wanted: int | None) -> tuple[int, int]:
        """Buckets and parts are fixed by the first use of a root and read back afterwards."""
        kept = self.noted("buckets")
        if kept is not None:
            return int(kept), int(self.noted("parts") or min(int(kept), FORMER_PARTS))
        buckets = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.note("pending_loads", "[]")
        self.note("parts", str(buckets))
        self.note("buckets", str(buckets))
        return buckets, buckets

    def note(self, name: str, value: str, mark: str | None = None) -> None:
        """Keep a remark beside the tables, with the mark of the work that it is about.

        Two places take turns, so a crash while one is written leaves the other, the last complete
        remark, in force.
        """
        last = self._last_note(name)
        number = last["number"] + 1 if last else 1
        one_row = self.spark.range(1, numPartitions=1).select(
            F.lit(number).cast("long").alias("number"),
            F.lit(value).alias("value"),
            F.lit(mark).cast("string").alias("mark"),
        )
        one_row.write.mode("overwrite").json(f"{self.root}/state/{name}/{number % 2}")

    def noted(self, name: str) -> str | None:
        return self.noted_and_marked(name)[0]

    def noted_and_marked(self, name: str) -> tuple[str | None, str | None]:
        """The last remark and its mark."""
        last = self._last_note(name)
        return (last["value"], last["mark"]) if last else (None, None)

    def _last_note(self, name: str):
        """The last complete remark; warehouses of before kept one a folder in ``notes``."""
        for folder in (f"{self.root}/state/{name}", f"{self.root}/notes/{name}/*"):
            reader = self.spark.read.schema("number long, value string, mark string")
            try:
                notes = reader.option("recursiveFileLookup", True).json(folder)
            except AnalysisException:
                continue
            number = F.regexp_extract(F.input_file_name(), r"number=(\d+)", 1).try_cast("long")
            numbered = notes.withColumn("number", F.coalesce("number", number))
            last = numbered.where("value is not null").orderBy(F.desc("number")).first()
            if last is not None:
                return last
        return None

    def pending_loads(self) -> list[str] | None:
        """Loads that no build has taken yet, or None where that isn't known of any load."""
        noted = self.noted("pending_loads")
        return None if noted is None else json.loads(noted)

    def expect(self, load_id: str) -> None:
        """Note a load before it is written, so that the next build looks at it."""
        pending = self.pending_loads()
        if pending is not None and load_id not in pending:
            self.note("pending_loads", json.dumps([*pending, load_id]))

    def settle(self, taken: Iterable[str] | None) -> None:
        """Note that loads, or all of them, have been taken."""
        held = set(self.pending_loads() or [])
        left = sorted(held - set(held if taken is None else taken))
        if taken is None or left != sorted(held):
            self.note("pending_loads", json.dumps(left))

    def _declare(self, table: str) -> None:
        """Make a table known to the catalog, with the files it may already have."""
        name = self.qualified(table)
        if table in self._declared:
            return
        self._declared.add(table)
        if self.spark.catalog.tableExists(name):
            return
        layout = LAYOUTS[table]
        found = self._found(table)
        known = {column for column, _ in (*layout.columns, *layout.partitions)}
        added = [column for column in found or [] if column[0] not in known]
        fields = [*layout.columns, *added, *layout.partitions]
        ddl = f"CREATE TABLE {name} ({_listed(fields)}) USING parquet"
        if layout.partitions:
            keys = ", ".join(column for column, _ in layout.partitions)
            ddl += f" OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({keys})"
        if layout.bucket_sort:
            ddl += (
                f" CLUSTERED BY (match_id) SORTED BY ({', '.join(layout.bucket_sort)})"
                f" INTO {self.buckets} BUCKETS"
            )
        self.spark.sql(f"{ddl} LOCATION '{self._location(table)}'")
        if layout.partitions and found:
            self.spark.sql(f"MSCK REPAIR TABLE {name}")

    def _found(self, table: str) -> list[tuple[str, str]] | None:
        """The columns of a table's files, if the folder holds any from an earlier session."""
        try:
            files = self.spark.read.option("mergeSchema", True).parquet(self._location(table))
        except AnalysisException:
            return None
        return [(field.name, field.dataType.simpleString()) for field in files.schema]

    def _location(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def qualified(self, table: str) -> str:
        return f"{self.database}.{table}"

    def stored(self, table: str) -> DataFrame:
        """A table with all columns it is stored with."""
        place = table
        if table in PUBLISHED:
            number = self._published()
            place = _at(table, number)
            self._declare(place)
            if self._read.get(table) != number:  # another session may have filled the place
                self.spark.catalog.refreshTable(self.qualified(place))
                self._read[table] = number
        self._declare(place)
        return self.spark.table(self.qualified(place))

    def _published(self) -> int:
        """How many times the dimensions have been published."""
        return int(self.noted("published") or 0)

    def table(self, table: str) -> DataFrame:
        """A table as its readers know it."""
        if table == "raw_match_json":
            return self.accepted().select(schemas.RAW_COLUMNS)
        if table == "dim_match":
            return self.stored("match_header").select(schemas.DIM_MATCH_COLUMNS)
        return self.stored(table).drop("part")

    def accepted(self) -> DataFrame:
        """Sound documents, with their header branch kept as a narrow column of its own."""
        return self.stored("raw_match_json").where("accepted")

    def rejects(self) -> DataFrame:
        """Files turned away, as they came last, unless they came again and were accepted."""
        turned_away = self.stored("raw_match_json").where("not accepted").groupBy("file_name")
        last = turned_away.agg(
            F.max(F.struct("loaded_at", "reason")).alias("last")
        ).select("file_name", "last.reason", "last.loaded_at")
        return last.join(self.accepted().select("file_name").distinct(), "file_name", "left_anti")

    def by_bucket(self, rows: DataFrame) -> DataFrame:
        """Rows shuffled so that each task holds whole buckets."""
        return rows.repartition(self.buckets, "match_id")

    def _fields(self, table: str):
        self._declare(table)
        return self.spark.table(self.qualified(table)).schema

    def _insert(self, table: str, rows: DataFrame, overwrite: bool) -> None:
        if LAYOUTS[table].partitions == BY_PART:
            rows = rows.withColumn("part", F.pmod(F.hash("match_id"), F.lit(self.parts)))
        columns = [
            F.col(field.name)
            if field.name in rows.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in self._fields(table)
        ]
        with self._whole_variants(rows.sparkSession):
            rows.select(columns).write.insertInto(self.qualified(table), overwrite=overwrite)
        if rows.sparkSession is not self.spark:  # whose list of files is one of before
            self.spark.catalog.refreshTable(self.qualified(table))

    @contextmanager
    def _whole_variants(self, session: SparkSession) -> Iterator[None]:
        """Store variants unshredded: balls are always read together, and putting them back
        together from hundreds of leaf columns costs more than it saves. The session is that of
        the rows; a stream's batch has one of its own."""
        setting = "spark.sql.variant.writeShredding.enabled"
        before = session.conf.get(setting)
        session.conf.set(setting, "false")
        try:
            yield
        finally:
            session.conf.set(setting, before)

    def append(self, table: str, rows: DataFrame) -> None:
        self._insert(table, rows, overwrite=False)

    def replace(self, table: str, rows: DataFrame) -> None:
        """Put rows in place of the partitions they fall into."""
        self._insert(table, rows, overwrite=True)

    def publish(self, tables: dict[str, DataFrame]) -> None:
        """Put rows in place of all dimensions, at once for those who read them."""
        if set(tables) != set(PUBLISHED):
            raise ValueError(f"publish takes all of {', '.join(PUBLISHED)}")
        number = self._published() + 1
        for table, rows in tables.items():
            self._insert(_at(table, number), rows, overwrite=True)
        self.note("published", str(number))

    def clear(self, table: str) -> None:
        """Empty a partitioned table."""
        keys = [column for column, _ in LAYOUTS[table].partitions]
        nothing = self.spark.range(0).select(
            [F.lit(None).cast(f.dataType).alias(f.name) for f in self.stored(table).schema]
        )
        writer = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(keys).parquet(self._location(table))
        self.spark.sql(f"MSCK REPAIR TABLE {self.qualified(table)} SYNC PARTITIONS")

    def add_columns(self, table: str, columns: list[tuple[str, str]]) -> None:
        """Append columns to a table; rows already there hold null in them."""
        if columns:
            self.spark.sql(
                f"ALTER TABLE {self.qualified(table)} ADD COLUMNS ({_listed(columns)})"
            )


def _listed(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)
