"""What a caller declares about a table or a feed, and the schemas of the control frames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from tieout import fixed_values as V


@dataclass(frozen=True)
class MergeSpec:
    """Columns of a current-state table. Large columns are a subset of the values.

    `buckets` is how many parts its keys are dealt into where it is stored by bucket.
    """

    keys: tuple[str, ...]
    values: tuple[str, ...]
    large: tuple[str, ...] = ()
    buckets: int = V.KEY_BUCKETS
    name: str = "state"

    def __post_init__(self) -> None:
        if not set(self.large) <= set(self.values):
            raise ValueError("a large column must also be a value column")

    @property
    def small(self) -> tuple[str, ...]:
        return tuple(c for c in self.values if c not in self.large)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.values, *LINEAGE)


@dataclass(frozen=True)
class FeedContract:
    keys: tuple[str, ...]
    amount: str = "amount_paise"
    truncation_threshold: float = V.TRUNCATION_THRESHOLD
    reference: bool = False  # announced when a new version goes live
    optional: bool = False  # a missing delivery is a declared gap

    @classmethod
    def from_document(cls, document: dict) -> FeedContract:
        """Read the feed's contract from its parsed YAML or JSON document (the ODCS layout)."""
        (table,) = document["schema"]
        custom = {p["property"]: p["value"] for p in document.get("customProperties", ())}
        return cls(
            keys=tuple(p["name"] for p in table["properties"] if p.get("primaryKey")),
            truncation_threshold=custom.get("truncationThreshold", V.TRUNCATION_THRESHOLD),
            reference=custom.get("reference", False),
            optional=custom.get("optional", False),
        )


@dataclass(frozen=True)
class ColumnRule:
    """One contracted column: its type, whether it may be null, and its allowed values."""

    name: str
    type: str = "string"
    required: bool = False
    primary_key: bool = False
    unique: bool = False
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class DataContract:
    name: str
    columns: tuple[ColumnRule, ...]
    metric_filters: dict[str, tuple[str, str]] = field(default_factory=dict)

    @classmethod
    def from_document(cls, document: dict) -> DataContract:
        """Read the contract from its parsed YAML or JSON document (the ODCS layout)."""
        (table,) = document["schema"]
        return cls(
            document["name"],
            tuple(
                ColumnRule(
                    name=p["name"],
                    type=p.get("physicalType", _LOGICAL_TYPES[p["logicalType"]]),
                    required=p.get("required", False),
                    primary_key=p.get("primaryKey", False),
                    unique=any(q.get("metric") == "duplicateValues" for q in p.get("quality", ())),
                    allowed=tuple(
                        value
                        for q in p.get("quality", ())
                        if q.get("metric") == "invalidValues"
                        for value in q["arguments"]["validValues"]
                    ),
                )
                for p in table["properties"]
            ),
        )

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(c.name, T.DataType.fromDDL(c.type), not c.required)
                for c in self.columns
            ]
        )


_LOGICAL_TYPES = {
    "string": "string", "integer": "bigint", "date": "date", "timestamp": "timestamp",
    "boolean": "boolean",
}

LINEAGE = ("source_incarnation", "source_lsn", "is_deleted", "updated_at")
DELIVERY = ("partner", "feed", "posting_date")
VERSION = (*DELIVERY, "sequence_number")

DATA_COLLECTIONS = "array<struct<data_collection: string, event_count: bigint>>"
TRANSACTIONS = (
    f"position bigint, transaction_id string, status string, data_collections {DATA_COLLECTIONS}, "
    "committed_at timestamp"
)
REGISTER = (
    "file_id string, file_hash string, partner string, feed string, posting_date date, "
    "sequence_number bigint, part_number int, part_count int, row_count bigint, "
    "amount_paise bigint, state string, reason string, registered_at timestamp, load_id bigint"
)
POINTER = (
    "partner string, feed string, posting_date date, sequence_number bigint, "
    "valid_from timestamp, valid_to timestamp, approved_by string"
)
INPUT_STATUS = "name string, complete boolean, detail string"
RELEASES = (
    "table_name string, release_id bigint, parent_release bigint, slices array<string>, "
    "label map<string,string>, state string, reason string, created_at timestamp, "
    "published_at timestamp, reconciled boolean"
)
MANIFEST = (
    "table_name string, slice string, release_id bigint, valid_from timestamp, valid_to timestamp"
)
CUTS = (
    "source string, position bigint, transaction_id string, committed_at timestamp, "
    "table_name string, release_id bigint, cut_at timestamp"
)
TAGS = "table_name string, tag string, release_id bigint, tagged_at timestamp, keep_until timestamp"
VAULT = "kind string, value string, token string, customer_id string, retention_class string"
