"""``Sources``: logical source name -> DataFrame conforming to its contract."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from rewardseg.sources.contracts import CONTRACTS, conform


class Sources(Mapping):
    """Lazy mapping from the 20 logical source names to DataFrames.

    Each entry is built once on first access and conformed to its contract.
    Builders are plain callables so a deployment can point any source at a
    catalog table, a parquet folder or a derived DataFrame.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]],
                 columns: Mapping[str, Mapping[str, str]] | None = None):
        unknown = set(builders) - set(CONTRACTS)
        if unknown:
            raise KeyError(f"unknown sources {sorted(unknown)}")
        self._builders = dict(builders)
        self._columns = {name: dict(names) for name, names in (columns or {}).items()}
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._builders:
                raise KeyError(f"source {name!r} is not configured")
            self._cache[name] = conform(self._builders[name](), name, self._columns.get(name))
        return self._cache[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, str],
                    columns: Mapping[str, Mapping[str, str]] | None = None) -> "Sources":
        """Catalog tables by qualified name, e.g. ``{"burn_fact": "db.burn"}``;
        ``columns`` maps contract columns to a table's own names, e.g.
        ``{"burn_fact": {"tran_points": "points"}}``."""
        return cls({name: (lambda t=t: spark.read.table(t)) for name, t in tables.items()}, columns)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str,
                     names: Mapping[str, str] | None = None,
                     columns: Mapping[str, Mapping[str, str]] | None = None) -> "Sources":
        """One parquet folder per source under ``root`` (file name = source
        name unless ``names`` maps it)."""
        names = dict(names or {n: n for n in CONTRACTS})
        return cls({n: (lambda p=p: spark.read.parquet(f"{root}/{p}")) for n, p in names.items()}, columns)
