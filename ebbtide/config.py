"""Settings shared by every job of the lake."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

# id -> schema text; a mapping or any callable that looks one id up.
SchemaLookup = Mapping[int, str] | Callable[[int], str]

MIB = 1024 * 1024

# Where the messages of each environment come from.
KAFKA_SERVERS = {
    "local": {"bootstrap_servers": "localhost:9092"},
    "example": {"bootstrap_servers": "broker:29092"},
}


@dataclass(frozen=True)
class Settings:
    """Where the layers live and how much one run may take.

    ``base`` is put in front of the bucket names, so ``prefix_protocol="file",
    base="/data/"`` keeps a whole lake in a shared folder.
    """

    prefix_protocol: str = "s3"
    base: str = ""
    # The buckets of the layers and of checkpoints and histories.
    raw: str = "datalake-raw"
    staged: str = "datalake-staged"
    curated: str = "datalake-curated"
    spark_control: str = "spark-control"

    schema_registry: Mapping[str, SchemaLookup] = field(default_factory=dict)
    kafka: Mapping[str, Mapping] = field(default_factory=lambda: dict(KAFKA_SERVERS))

    # Compaction starts above this many files and aims at files of this size,
    # whatever the size of the table.
    max_num_files_allowed: int = 10_000
    target_file_bytes: int = 128 * MIB

    # Buckets of a curated table when it is made; it gets more as it grows, so that
    # each holds about these bytes.
    buckets: int = 8
    bucket_bytes: int = 1024 * MIB

    vacuum_every_versions: int = 25
    vacuum_retention_hours: float = 768

    # Limits of one micro-batch. Runs take everything that is available, in as
    # many batches as these limits ask for.
    max_offsets_per_trigger: int | None = 10_000_000
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = 256 * 1024 * MIB

    def bucket(self, layer: str) -> str:
        buckets = {"raw": self.raw, "staged": self.staged, "curated": self.curated}
        if layer not in buckets:
            raise KeyError(f"unknown layer {layer!r}, expected one of {sorted(buckets)}")
        return buckets[layer]

    def url(self, bucket: str) -> str:
        return f"{self.prefix_protocol}://{self.base}{bucket}"

    def schema_lookup(self, environment: str) -> SchemaLookup:
        if environment not in self.schema_registry:
            raise KeyError(f"no schema registry for environment {environment!r}")
        return self.schema_registry[environment]


DEFAULT = Settings()


def schema_text(lookup: SchemaLookup, schema_id: int) -> str:
    """The schema registered under one id; unknown ids fail."""
    text = lookup(schema_id) if callable(lookup) else lookup.get(schema_id)
    if text is None:
        raise KeyError(f"schema id {schema_id} is not registered")
    return text
