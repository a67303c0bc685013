"""Table versions: commits, branches, tags, time travel, isolated runs."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diff import is_changed
from ..operators.latest import latest_per_key
from ..operators.quality import Checks, require
from ..sinks.tables import write_parquet
from ..sources.files import data_files, timestamp_literal
from ..workdir import append_entry, make_folder, text_map

MAIN = "main"
UNKNOWN = "unknown"
_COMMIT = (
    "commit_id string, parent string, message string, metadata map<string,string>, committed_at timestamp_ntz, "
    "operation string, tables map<string,string>"
)
_TAG = "commit_id string"


class ConflictError(RuntimeError):
    """The target moved since the run began."""


@dataclass(frozen=True)
class Commit:
    branch: str
    version: int
    commit_id: str
    tables: Mapping[str, str]


class VersionLog:
    """A ledger of commits. A commit maps table names to the folders that hold them; folders never change.

    Each commit is one JSON entry under its branch and version number. Entries are written only where none exists, so of
    two commits of one version the second fails. On plain files that check and the write are two steps; where writers
    race within that moment, keep the ledger in a catalog with atomic commits.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        for part in ("log", "tags"):
            make_folder(spark, f"{self.path}/{part}")

    # Listing

    def commits(self) -> DataFrame:
        """All commits: `(branch, version, commit_id, parent, message, metadata, committed_at, operation, tables)`."""
        return self.spark.read.schema(f"{_COMMIT}, branch string, version int").json(f"{self.path}/log")

    def tags(self) -> DataFrame:
        return self.spark.read.schema(f"{_TAG}, tag string").json(f"{self.path}/tags")

    def head(self, branch: str = MAIN) -> Commit | None:
        row = latest_snapshot(self.commits().filter(F.col("branch") == branch)).first()
        return None if row is None else Commit(branch, row["version"], row["commit_id"], row["tables"])

    def resolve(self, ref: str) -> str:
        """Commit id of a branch, tag or commit; `unknown` when there is none."""
        refs = self.spark.range(1).select(F.lit(ref).alias("ref"))
        return resolve_refs(refs, self.commits(), self.tags()).first()["commit_id"]

    def commit_of(self, ref: str) -> Commit:
        row = self.commits().filter(F.col("commit_id") == self.resolve(ref)).first()
        if row is None:
            raise ValueError(f"no commit is named {ref}")
        return Commit(row["branch"], row["version"], row["commit_id"], row["tables"])

    # Reading

    def read(self, table: str, ref: str = MAIN) -> DataFrame:
        """A table as of a branch, tag or commit."""
        commit = self.commit_of(ref)
        if table not in commit.tables:
            raise ValueError(f"{ref} has no table {table}")
        return self.spark.read.parquet(commit.tables[table])

    def read_version(self, table: str, version: int, branch: str = MAIN) -> DataFrame:
        row = self.commits().filter((F.col("branch") == branch) & (F.col("version") == version)).first()
        if row is None or table not in row["tables"]:
            raise ValueError(f"{branch} has no version {version} of {table}")
        return self.spark.read.parquet(row["tables"][table])

    def read_at(self, table: str, moment: datetime, branch: str = MAIN) -> DataFrame:
        """A table as it was at a point in time."""
        row = latest_snapshot(self.commits().filter((F.col("branch") == branch) & (F.col("committed_at") <= timestamp_literal(moment)))).first()
        if row is None or table not in row["tables"]:
            raise ValueError(f"{table} did not exist on {branch} at {moment}")
        return self.spark.read.parquet(row["tables"][table])

    def files(self, table: str, ref: str = MAIN) -> DataFrame:
        return data_files(self.read(table, ref))

    # Writing

    def store(self, table: str, df: DataFrame, run: str) -> str:
        """Write a table into a folder of its own."""
        path = f"{self.path}/data/{run}/{table}"
        write_parquet(df, path)
        return path

    def commit(
        self,
        branch: str,
        tables: Mapping[str, str],
        message: str,
        committed_at: datetime,
        metadata: Mapping[str, str] | None = None,
        base_version: int | None = None,
        operation: str = "commit",
    ) -> Commit:
        """Append a commit that changes the given tables. `base_version` is the head the change was made from."""
        return self._append(self.head(branch), branch, tables, message, committed_at, metadata, base_version, operation)

    def _append(self, head, branch, tables, message, committed_at, metadata=None, base_version=None, operation="commit") -> Commit:
        version = 0 if head is None else head.version + 1
        if base_version is not None and base_version != version - 1:
            raise ConflictError(f"{branch} is at version {version - 1}, the run began at {base_version}")
        merged = {**(head.tables if head else {}), **tables}
        parent = head.commit_id if head else None
        text = "|".join([branch, str(version), str(parent), message, committed_at.isoformat(), *[f"{k}={v}" for k, v in sorted(merged.items())]])
        commit_id = hashlib.sha256(text.encode()).hexdigest()
        entry = {
            "commit_id": F.lit(commit_id),
            "parent": F.lit(parent),
            "message": F.lit(message),
            "metadata": text_map(metadata or {}),
            "committed_at": timestamp_literal(committed_at),
            "operation": F.lit(operation),
            "tables": text_map(merged),
        }
        try:
            append_entry(self.spark, f"{self.path}/log/branch={branch}/version={version}", entry, "errorifexists")
        except AnalysisException as error:
            raise ConflictError(f"version {version} of {branch} was written meanwhile") from error
        return Commit(branch, version, commit_id, merged)

    def commit_table(
        self,
        branch: str,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        message: str,
        committed_at: datetime,
        run: str,
        metadata: Mapping[str, str] | None = None,
    ) -> Commit | None:
        """Store a table and commit it unless it equals the branch's version in schema and row by row; then there is no commit."""
        head = self.head(branch)
        path = self.store(table, df, run)
        if head is not None and table in head.tables:
            old, new = self.spark.read.parquet(head.tables[table]), self.spark.read.parquet(path)
            if not is_changed(old, new, keys):
                return None
        # The head read above is the base: a commit made meanwhile has taken the version number.
        return self._append(head, branch, {table: path}, message, committed_at, metadata)

    def tag(self, name: str, commit_id: str) -> bool:
        """Name a commit. Repeating a tag is fine, moving it is not; unknown commits are skipped."""
        if commit_id == UNKNOWN or not commit_id:
            return False
        have = self.tags().filter(F.col("tag") == name).first()
        if have is not None:
            return have["commit_id"] == commit_id
        append_entry(self.spark, f"{self.path}/tags/tag={name}", {"commit_id": F.lit(commit_id)}, "errorifexists")
        return True

    def tag_model_data(self, model: str, version: str | int, commit_id: str) -> str | None:
        name = model_tag(model, version)
        return name if self.tag(name, commit_id) else None

    def begin(self, run: str, target: str = MAIN) -> Run:
        head = self.head(target)
        return Run(self, run, target, -1 if head is None else head.version, {})


@dataclass
class Run:
    """Tables written apart from the target, and published together once they pass their checks."""

    log: VersionLog
    name: str
    target: str
    base_version: int
    tables: dict[str, str]

    def write(self, table: str, df: DataFrame, checks: Checks | None = None) -> DataFrame:
        """Write a table, read it back, and check it. A failed check raises, so the run is never published."""
        path = self.log.store(table, df, self.name)
        back = self.log.spark.read.parquet(path)
        if checks is not None:
            require(back, checks, table)
        self.tables[table] = path
        return back

    def publish(self, message: str, committed_at: datetime, metadata: Mapping[str, str] | None = None) -> Commit | None:
        """Commit all tables to the target, or raise when it moved. A run without tables has nothing to publish."""
        if not self.tables:
            return None
        more = {"run_id": self.name, **(metadata or {})}
        return self.log.commit(self.target, self.tables, message, committed_at, more, base_version=self.base_version, operation="merge")


# The same questions asked of ledger tables

def latest_snapshot(commits: DataFrame, group: Sequence[str] = (), time: str = "committed_at", version: str = "version") -> DataFrame:
    """The newest commit, of each group if there are any."""
    return latest_per_key(commits, list(group), time, [version])


def resolve_refs(refs: DataFrame, commits: DataFrame, tags: DataFrame) -> DataFrame:
    """Append the commit id each `ref` names: a branch's head, a tag or a commit; `unknown` for any other text."""
    heads = latest_snapshot(commits.select("branch", "version", "committed_at", "commit_id"), ["branch"])
    names = (
        heads.select(F.col("branch").alias("ref"), "commit_id", F.lit(0).alias("o"))
        .unionByName(tags.select(F.col("tag").alias("ref"), "commit_id", F.lit(1).alias("o")))
        .unionByName(commits.select(F.col("commit_id").alias("ref"), "commit_id", F.lit(2).alias("o")))
    )
    # Only names that are asked for are grouped. Branches win over tags, tags over commits.
    found = names.join(refs.select("ref").distinct(), "ref").groupBy("ref").agg(F.min_by("commit_id", "o").alias("commit_id"))
    return refs.join(found, "ref", "left").withColumn("commit_id", F.coalesce("commit_id", F.lit(UNKNOWN)))


def version_drift(trained: DataFrame, current: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """Whether the current version is the one that was trained on."""
    now = current.select(*keys, F.col(version).alias("current_version"))
    joined = trained.select(*keys, F.col(version).alias("trained_version")).join(now, list(keys), "left")
    return joined.withColumn("drifted", ~F.col("trained_version").eqNullSafe(F.col("current_version")))


def new_commits(proposed: DataFrame, changes: Column) -> DataFrame:
    """Proposals that change something; without changes there is no commit."""
    return proposed.filter(changes > 0)


def model_tag(model: str, version: str | int) -> str:
    return f"model-{model}-v{version}-data"


def add_tags(tags: DataFrame, proposed: DataFrame) -> DataFrame:
    """Tags with the proposed ones added: existing names stay, unknown commits are skipped, repeats count once."""
    valid = proposed.filter(F.col("commit_id").isNotNull() & ~F.col("commit_id").isin(UNKNOWN, ""))
    fresh = valid.groupBy("tag").agg(F.min("commit_id").alias("commit_id")).join(tags.select("tag"), "tag", "left_anti")
    return tags.select("tag", "commit_id").unionByName(fresh.select("tag", "commit_id"))
