"""Problem 2: each run processes only what was added or changed since the last committed run.

A store folder holds `log/<n>.json`, one file per committed run, put in place by a single rename.
It names the run's watermark, its output and its state, so output and watermark become visible
together or not at all. A run fixes its upper bound before it reads; rows that arrive meanwhile wait
for the next run. What a failed run wrote is named by no log file and is ignored. Rows without a sequence
number have no place in that order: they are taken once each, told by their content, whenever they are first
seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions.text import clean_key


class Lost(RuntimeError):
    """Another run committed first."""


@dataclass(frozen=True)
class Bounds:
    number: int
    lower: int | None
    upper: int | None

    def slice(self, rows: DataFrame, seq: str) -> DataFrame:
        """Rows of (lower, upper]; rows without sequence number are in no slice."""
        if self.upper is None:
            return rows.filter(F.lit(False))
        inside = F.col(seq) <= self.upper
        return rows.filter(inside if self.lower is None else inside & (F.col(seq) > self.lower))


class CommitStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def last(self) -> dict | None:
        """The newest commit; each log file holds all that a reader needs."""
        log = self._Path(f"{self.root}/log")
        if not self._fs.exists(log):
            return None
        names = sorted(x.getPath().getName() for x in self._fs.listStatus(log) if x.getPath().getName().endswith(".json"))
        if not names:
            return None
        stream = self._fs.open(self._Path(f"{self.root}/log/{names[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def begin(self, rows: DataFrame, seq: str) -> Bounds:
        """Fix the bounds of the next run; the upper one is read once, here."""
        done = self.last()
        lower = done["watermark"] if done else None
        top = rows.agg(F.max(seq).alias("top")).first()["top"]
        upper = lower if top is None else top if lower is None else max(top, lower)
        return Bounds(done["number"] + 1 if done else 1, lower, upper)

    def aside(self, bounds: Bounds) -> str:
        """A folder of this attempt's own; nothing in it counts before the commit."""
        return f"{self.root}/data/{bounds.number:08d}-{uuid.uuid4().hex[:8]}"

    def unnumbered(self, rows: DataFrame, seq: str, done: dict | None, aside: str) -> tuple[DataFrame, str]:
        """(rows without sequence number that no run has taken, folder of the marks of all taken ones).

        The new rows are written before they are used, so the run and its marks see the same ones. Rows equal in
        all columns count as one.
        """
        own = rows.filter(F.col(seq).isNull()).withColumn("_mark", F.sha2(F.to_json(F.struct(*rows.columns)), 256)).dropDuplicates(["_mark"])
        taken = self.spark.read.schema("_mark string").parquet(done["unnumbered"]) if done and done.get("unnumbered") else None
        own = own if taken is None else own.join(taken, "_mark", "left_anti")
        own.write.parquet(f"{aside}/rows")
        own = self.spark.read.schema(own.schema).parquet(f"{aside}/rows")
        marks = own.select("_mark") if taken is None else own.select("_mark").unionByName(taken)
        marks.write.parquet(f"{aside}/marks")
        return own.select(*rows.columns), f"{aside}/marks"

    def commit(self, bounds: Bounds, output: DataFrame, state: DataFrame | None = None, aside: str | None = None, unnumbered: str | None = None) -> dict:
        """Write output and state aside, then make both and the watermark valid by one rename."""
        aside = aside or self.aside(bounds)
        output.write.parquet(f"{aside}/output")
        if state is not None:
            state.write.parquet(f"{aside}/state")
        entry = {"number": bounds.number, "watermark": bounds.upper, "output": f"{aside}/output", "state": f"{aside}/state" if state is not None else None, "unnumbered": unnumbered}
        draft, final = self._Path(f"{aside}/entry.json"), self._Path(f"{self.root}/log/{bounds.number:08d}.json")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        self._fs.mkdirs(self._Path(f"{self.root}/log"))
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise Lost(f"run {bounds.number} was committed by another")
        return entry

    def run(self, rows: DataFrame, seq: str, step: Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame | None]]) -> dict:
        """One run: bounds, step(slice, state before) -> (output, state after), commit."""
        done = self.last()
        bounds = self.begin(rows, seq)
        before = self.spark.read.parquet(done["state"]) if done and done["state"] else None
        aside = self.aside(bounds)
        more, marks = self.unnumbered(rows, seq, done, aside)
        output, state = step(bounds.slice(rows, seq).unionByName(more), before)
        return self.commit(bounds, output, state, aside, marks)

    def apply(self, number: int, step: Callable[[DataFrame | None], tuple[DataFrame, DataFrame | None]]) -> dict:
        """One run over changes that the caller numbers: step(state before) -> (output, state after). A number that
        a run has already committed is not applied again."""
        done = self.last()
        if done and done["watermark"] is not None and number <= done["watermark"]:
            return done
        bounds = Bounds(done["number"] + 1 if done else 1, done["watermark"] if done else None, number)
        before = self.spark.read.parquet(done["state"]) if done and done["state"] else None
        return self.commit(bounds, *step(before))


def latest_by_path(slice_: DataFrame, before: DataFrame | None) -> DataFrame:
    """Of each path the row with the greatest (seen_at, scan_id), over the slice and the state before.

    Nulls sort first, so a row without time never hides one with a time. Rows without a path are left
    out: they tell nothing about any file. Of equal (seen_at, scan_id) the greatest hash stands.
    """
    cols = ["path_key", "seen_at", "scan_id", "file_hash", "change_type"]
    rows = slice_.withColumn("path_key", clean_key(F.col("original_path"))).filter("path_key is not null").select(*cols)
    if before is not None:
        rows = rows.unionByName(before.select(*cols))
    best = F.max(F.struct("seen_at", "scan_id", "file_hash", "change_type"))
    return rows.groupBy("path_key").agg(best.alias("x")).select("path_key", "x.*")


def done_contents(manifest: DataFrame, runs: DataFrame) -> DataFrame:
    """Hashes that a succeeded run processed at the current version: (hash_key).

    The run table is fixed and small, but its size isn't taken for granted: succeeded runs that overlap
    a day are matched by that day, so the interval check needs no broadcast. Null times match nothing.
    """
    current = runs.filter("started_at is not null").agg(F.max(F.struct("started_at", clean_key(F.col("pipeline_version")).alias("v"))).alias("x")).select(F.col("x.v").alias("version"))
    held = runs.filter("lower(trim(status)) = 'succeeded' and started_at is not null and finished_at is not null and started_at <= finished_at")
    held = held.select("started_at", "finished_at", F.explode(F.sequence(F.to_date("started_at"), F.to_date("finished_at"))).alias("day"))
    at = F.try_to_timestamp(F.col("processed_at"))
    rows = manifest.select(clean_key(F.col("file_hash")).alias("hash_key"), clean_key(F.col("pipeline_version")).alias("version"), at.alias("at"))
    rows = rows.filter("hash_key is not null and at is not null").withColumn("day", F.to_date("at")).distinct()
    rows = rows.join(current, "version", "left_semi").join(held, "day")
    return rows.filter("at between started_at and finished_at").select("hash_key").distinct()


def pending_step(manifest: DataFrame, runs: DataFrame) -> Callable:
    def step(slice_: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        state = latest_by_path(slice_, before)
        current = state.filter("file_hash is not null and coalesce(lower(trim(change_type)), '') <> 'removed'").select("file_hash", clean_key(F.col("file_hash")).alias("hash_key"))
        return current.join(done_contents(manifest, runs), "hash_key", "left_anti").select("file_hash").filter("trim(file_hash) <> ''").distinct(), state

    return step


def plan_next_run(spark: SparkSession, scans: DataFrame, manifest: DataFrame, runs: DataFrame, root: str) -> DataFrame:
    """The contents the next run has to process, committed to the store at root with the watermark."""
    entry = CommitStore(spark, root).run(scans, "scan_id", pending_step(manifest, runs))
    return spark.read.schema("file_hash string").parquet(entry["output"])
