"""Declarative cleaning: typed projection, row rules, latest row per key, derived columns, lineage.

Expressions are SQL text: a whole step is one call to Spark, however many columns it has.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.latest import keep_latest

AUDIT = {"ingestion_time": "timestamp", "source_file": "string", "source_api": "string"}


@dataclass(frozen=True)
class Field:
    """One output column. ``source`` is the raw name when it differs; ``kind`` is ``text`` or a Spark type.

    Text is trimmed, blank text becomes NULL unless ``blank_is_null`` is off, and ``fold`` is ``lower``, ``upper``
    or ``keep``. Typed columns use ``try_cast``: a value that does not parse becomes NULL, and the row rules decide.
    """

    name: str
    kind: str = "text"
    source: str | None = None
    fold: str = "keep"
    required: bool = False
    blank_is_null: bool = True

    def sql(self) -> str:
        raw = f"`{self.source or self.name}`"
        if self.kind == "text":
            value = f"trim(cast({raw} AS string))"
            value = f"nullif({value}, '')" if self.blank_is_null else value
            value = value if self.fold == "keep" else f"{self.fold}({value})"
        else:
            value = f"try_cast({raw} AS {self.kind})"
        return f"{value} AS `{self.name}`"


@dataclass(frozen=True)
class CleanSpec:
    source: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    rules: tuple[str, ...] = ()
    derived: Mapping[str, str] = field(default_factory=dict)

    def accepts(self) -> str:
        """Condition for a typed row to be kept."""
        required = [f"`{f.name}` IS NOT NULL" for f in self.fields if f.required]
        return " AND ".join([*required, *[f"({r})" for r in self.rules]])


def tidy(raw: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Typed and normalised columns plus the audit columns the source has, in one projection."""
    audit = [f"cast({c} AS {t}) AS {c}" for c, t in AUDIT.items() if c in raw.columns]
    return raw.selectExpr(*[f.sql() for f in fields], *audit)


def stamp(df: DataFrame, record_source: str, at: str = "silver_processed_at") -> DataFrame:
    """Lineage columns."""
    return df.withColumns({at: F.current_timestamp(), "record_source": F.lit(record_source)})


def clean(raw: DataFrame, spec: CleanSpec) -> DataFrame:
    """Rows that pass every rule, the latest one per key."""
    latest = keep_latest(tidy(raw, spec.fields).filter(spec.accepts()), spec.key)
    derived = [f"{sql} AS `{name}`" for name, sql in spec.derived.items()]
    return stamp(latest.selectExpr("*", *derived) if derived else latest, spec.source)
