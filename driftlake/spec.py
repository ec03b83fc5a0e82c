"""What a captured table looks like: its key, its attributes and its event order."""

from __future__ import annotations

from dataclasses import dataclass
from dataclasses import field as dataclass_field


# Columns that decoding adds; a captured column of the same name needs another one.
RESERVED = {"op", "version", "lsn", "offset", "payload"}

# Columns that may order events of one version: position in the source's log, in the topic.
TIE_BREAKERS = ("lsn", "offset")


@dataclass(frozen=True)
class TableSpec:
    """Describes one captured table.

    ``key`` and ``columns`` map a column name to the Spark SQL type it is cast to.
    ``fields`` names the JSON field of a column where it differs from the column.
    ``tie_breakers`` order two events of the same key and version; the topic offset is
    skipped where a DataFrame does not carry it.
    """

    name: str
    key: dict[str, str]
    columns: dict[str, str] = dataclass_field(default_factory=dict)
    topic: str | None = None
    fields: dict[str, str] = dataclass_field(default_factory=dict)
    tie_breakers: tuple[str, ...] = TIE_BREAKERS
    prefer_source_time: bool = False

    def __post_init__(self):
        if not self.key:
            raise ValueError(f"{self.name}: a captured table needs a key")
        if not set(self.tie_breakers) <= set(TIE_BREAKERS):
            raise ValueError(f"{self.name}: tie breakers are among {TIE_BREAKERS}")
        clash = (set(self.key) & set(self.columns)) | (set(self.row_columns) & RESERVED)
        if clash:
            raise ValueError(f"{self.name}: rename {sorted(clash)}, see fields")

    @property
    def keys(self) -> list[str]:
        return list(self.key)

    @property
    def attributes(self) -> list[str]:
        return list(self.columns)

    @property
    def row_columns(self) -> list[str]:
        return self.keys + self.attributes

    def json_field(self, column: str) -> str:
        return self.fields.get(column, column)

    def order_columns(self, available: list[str]) -> list[str]:
        """Event order, most significant first: version, then the tie-breakers.

        :func:`driftlake.operators.latest.event_order` adds the content, as one hash, so that
        the order is total.
        """
        return [c for c in ["version", *self.tie_breakers] if c in available]
