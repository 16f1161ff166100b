"""The registry's tables, states and constants: one declaration that the catalog, the checks and the queries share."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import IntEnum

from pyspark.sql import types as T


class State(IntEnum):
    """Where an artifact stands."""

    NEED_METADATA = 0
    NO_METADATA = 1
    NEED_CONVERT = 2
    READY = 3
    SKIPPED = 4
    QUARANTINED = 5
    DELETED = 6


#: The edges that an outcome may take. Ingestion, recovery and campaigns set states directly.
EDGES = [(0, 2), (0, 1), (0, 5), (1, 0), (2, 3), (2, 4), (2, 5), (3, 2), (3, 6), (4, 2), (5, 0)]
PENDING = [State.NEED_METADATA, State.NEED_CONVERT, State.QUARANTINED]
TERMINAL = [State.READY, State.SKIPPED, State.NO_METADATA, State.DELETED]

#: Retries, folds, archive sizes, alarms.
BACKOFF_BASE_S, BACKOFF_CAP_S, MAX_ATTEMPTS = 30.0, 21_600.0, 8
EMA_ALPHA = 0.2
EXAMPLES = 20
CLAIM_BATCH = 256
BLOCK_BYTES, SEAL_BYTES, SEAL_AGE_S, ZSTD_LEVEL = 4 << 20, 64 << 20, 21_600, 10
SIDECAR_BYTES, HANDOFF_BYTES = 32 << 20, 256 << 20
BREAKER_FAILURES, BREAKER_RECOVERY_S = 5, 60.0
DISK_FLOOR_BYTES, DISK_HYSTERESIS = 20 << 30, 1.2
ERROR_RETENTION_DAYS = 30


@dataclass(frozen=True)
class Table:
    """Columns with their Spark types, and the constraints that plain files cannot hold."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    def ddl(self) -> str:
        """CREATE TABLE from the same declaration."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in self.schema)
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet"


def _schema(text: str) -> T.StructType:
    """'name type, name type!' -> StructType; ! marks a column that must not be null."""
    kinds = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


RECORD = "name string, version string, build string, build_number int, subdir string, fn string, noarch string, depends array<string>, extra_depends map<string,array<string>>, name_resolutions array<struct<source_name:string,target_name:string>>"

# Columns by what they are for; an artifact has all four groups.
WHAT = "id long!, filename string!, project string!, target_name string"
REMOTE = "url string!, sha256 string, metadata_sha256 string, size long, requires string, upload_time string, yanked boolean!, yanked_reason string"
PROGRESS = "state int!, lane int!, blob_sha256 string, deleted_at timestamp"
CLOCKS = "serial long!, change_seq long!, updated_at timestamp!"
#: What an outcome belongs to.
STAGE_OF = "artifact_id long!, stage string!"


def _tables(*tables: Table) -> dict[str, Table]:
    return {t.name: t for t in tables}


#: The archive, then the artifacts that point into it, then what stages have to say about artifacts, then remote state.
TABLES = _tables(
    Table("segments", _schema("id long!, records long, bytes long, sealed_at timestamp"), ("id",)),
    Table("blobs", _schema("sha256 string!, segment_id long!, block_no long!, offset long!, length long!"), ("sha256",), references={"segment_id": ("segments", "id")}),
    Table("unlinked_blobs", _schema("filename string!, sha256 string!"), ("filename",)),
    Table("artifacts", _schema(", ".join([WHAT, REMOTE, PROGRESS, CLOCKS])), ("id",), ("filename",), {"blob_sha256": ("blobs", "sha256")}),
    Table("payloads", _schema("artifact_id long!, version string!, requires_prerelease boolean!, payload binary!"), ("artifact_id",), references={"artifact_id": ("artifacts", "id")}),
    Table("work", _schema(f"{STAGE_OF}, attempts int!, next_attempt_at timestamp!, quarantined_at timestamp"), ("artifact_id", "stage")),
    Table("skips", _schema(f"{STAGE_OF}, permanent boolean!, version string, reason string!, created_at timestamp!"), ("artifact_id", "stage")),
    Table("errors", _schema("id long!, artifact_id long, error_category string!, version string!, details string, created_at timestamp!"), ("id",)),
    Table("remote_index", _schema("name string!, serial long!, updated_at timestamp!"), ("name",)),
)
