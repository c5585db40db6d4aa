"""Named frames on shared storage, identified by what made them and checked by what they hold."""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import config_digest
from ..errors import DataContractError

NAME = re.compile(r"^[a-z][a-z0-9_]*$")
NULL = "<NA>"
METADATA = "identity string, content string, location string, created_at string"


def row_hash(frame: DataFrame) -> Column:
    """Hash of one row over its columns in name order, as text, with nulls spelled out."""
    kinds = {f.name: f.dataType.typeName() for f in frame.schema}
    texts = []
    for name in sorted(frame.columns):
        column = F.to_json(F.struct(F.col(f"`{name}`"))) if kinds[name] in ("array", "struct", "map") else F.col(f"`{name}`").cast("string")
        texts.append(F.coalesce(column, F.lit(NULL)))
    return F.xxhash64(*texts)


def fingerprint_frame(frame: DataFrame) -> DataFrame:
    """One row identifying the rows of a frame as a multiset: no sort, one combining aggregate."""
    wide = row_hash(frame).cast("decimal(38,0)")
    return frame.select(row_hash(frame).alias("h"), wide.alias("d")).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("d"), F.lit(0)).cast("string").alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("parity"),
    )


def fingerprint(frame: DataFrame) -> str:
    row = fingerprint_frame(frame).first()
    return config_digest([sorted(frame.columns), row["n"], row["total"], row["parity"]])


class FrameStore:
    """Every save goes to a folder of its own and is then listed; a reader sees the last listed one.

    The listing is appended last, so an interrupted save leaves the earlier frame in place. No rename is
    needed, which suits object stores.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")

    def _listing(self, name: str) -> str:
        if not NAME.match(name):
            raise DataContractError(f"Not a valid frame name: {name!r}")
        return f"{self.directory}/{name}/listing"

    def save(self, name: str, frame: DataFrame, identity) -> DataFrame:
        listing = self._listing(name)
        location = f"{self.directory}/{name}/{uuid.uuid4().hex}"
        frame.write.parquet(location)
        written = self.spark.read.schema(frame.schema).parquet(location)
        row = (config_digest(identity), fingerprint(written), location, datetime.now(timezone.utc).isoformat())
        self.spark.createDataFrame([row], METADATA).coalesce(1).write.mode("append").parquet(listing)
        return written

    def entry(self, name: str):
        try:
            listed = self.spark.read.schema(METADATA).parquet(self._listing(name))
            return listed.orderBy(F.col("created_at").desc()).first()
        except AnalysisException:
            return None

    def load(self, name: str, identity) -> DataFrame | None:
        """The saved frame; nothing if absent or made from something else; an error if it was damaged."""
        entry = self.entry(name)
        if entry is None or entry["identity"] != config_digest(identity):
            return None
        try:
            frame = self.spark.read.parquet(entry["location"])
        except AnalysisException as problem:
            raise DataContractError(f"The stored frame {name} is incomplete; make it again.") from problem
        if fingerprint(frame) != entry["content"]:
            raise DataContractError(f"The stored frame {name} has other content than was saved.")
        return frame


def write_csv(table: DataFrame, path: str) -> None:
    """One CSV file with a header; for report tables, which are small."""
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_records(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


SNAPSHOT_VERSION = 2
MANIFEST = "payload string, checksum string, saved_at string"


def save_snapshot(spark: SparkSession, directory: str, tables: dict[str, DataFrame], metadata: dict) -> str:
    """Save screened tables and metadata; returns the folder of this save.

    Tables go into a new folder, then one manifest row is appended with their content hashes and a checksum over
    everything. Readers go by the manifest alone, so a save that was interrupted leaves the one before it.
    """
    location, checks = f"{directory}/{uuid.uuid4().hex}", {}
    for name, table in tables.items():
        if not NAME.match(name):
            raise DataContractError(f"Not a valid table name: {name!r}")
        table.coalesce(1).write.parquet(f"{location}/{name}")
        checks[name] = fingerprint(spark.read.schema(table.schema).parquet(f"{location}/{name}"))
    payload = {"schema_version": SNAPSHOT_VERSION, "location": location, "tables": checks, "metadata": metadata}
    text = json.dumps(payload, sort_keys=True, default=str)
    row = [(text, config_digest(json.loads(text)), datetime.now(timezone.utc).isoformat())]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{directory}/manifest")
    return location


def load_snapshot(spark: SparkSession, directory: str) -> tuple[dict[str, DataFrame], dict]:
    """Tables and metadata of the last finished save, each checked against the manifest."""
    try:
        listed = spark.read.schema(MANIFEST).json(f"{directory}/manifest")
        row = listed.orderBy(F.col("saved_at").desc()).first()
    except AnalysisException:
        row = None
    if row is None:
        raise DataContractError("No finished report is saved here.")
    payload = json.loads(row["payload"])
    if config_digest(payload) != row["checksum"] or payload["schema_version"] != SNAPSHOT_VERSION:
        raise DataContractError("The saved report has another version or was changed.")
    tables = {}
    for name, check in payload["tables"].items():
        try:
            table = spark.read.parquet(f"{payload['location']}/{name}")
        except AnalysisException as problem:
            raise DataContractError(f"The saved table {name} is gone.") from problem
        if fingerprint(table) != check:
            raise DataContractError(f"The saved table {name} was changed.")
        tables[name] = table
    return tables, payload["metadata"]
