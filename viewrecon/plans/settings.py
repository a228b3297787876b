"""Settings of a run, from a mapping or the session, under two prefixes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

PREFIXES = ("viewrecon.", "spark.viewrecon.")


@dataclass(frozen=True)
class Settings:
    """``repaired_table``: a path or table that takes the repaired view. Scope bounds are inclusive seconds; the defaults leave out every record with a positive write time."""

    start_seconds: int = -1
    end_seconds: int = -1
    namespace: str | None = None
    base_table: str | None = None
    view_table: str | None = None
    fix_missing: bool = False
    fix_orphans: bool = False
    fix_inconsistent: bool = False
    use_latest_timestamp: bool = False
    scan_rows_per_second: int = 0
    mutations_per_second: int = 0
    read_options: str = ""
    write_options: str = ""
    repaired_table: str | None = None
    output_dir: str = "viewrecon-report"

    @classmethod
    def from_mapping(cls, given: Mapping[str, str]) -> Settings:
        """The first prefix wins; an empty value means the default."""
        found = {}
        for f in fields(cls):
            text = next((v for p in PREFIXES if (v := given.get(p + f.name)) not in (None, "")), None)
            if text is None:
                continue
            if f.type == "bool":
                found[f.name] = str(text).strip().lower() == "true"
            else:
                found[f.name] = int(text) if f.type == "int" else str(text)
        return cls(**found)

    @classmethod
    def from_session(cls, spark: SparkSession) -> Settings:
        names = (p + f.name for f in fields(cls) for p in PREFIXES)
        return cls.from_mapping({n: v for n in names if (v := spark.conf.get(n, None)) is not None})

    @staticmethod
    def options(text: str) -> dict[str, str]:
        """``a=b;c=d``: options for a reader or writer, such as a connector's host, credentials or consistency."""
        return dict(part.split("=", 1) for part in text.split(";") if "=" in part)
