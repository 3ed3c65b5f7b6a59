"""The set of relations a report reads, loaded lazily by name."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import RELATIONS, SCHEMAS


MONTH = "_month"  # the first day of the month, a partition column of landed tables


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def layout_table(name: str, key: str) -> str:
    """Name of the table that holds relation ``name`` bucketed by ``key``."""
    return f"{name}__by_{key}"


def hot_table(table: str) -> str:
    """Name of the table with the rows of ``table``'s hot documents."""
    return f"{table}__hot"


def empty_strings_as_null(df: DataFrame) -> DataFrame:
    """Oracle stores '' as NULL; normalise once at ingest so NVL / IS NULL agree.

    Apply it when the data lands (``landing.land_tables(normalize=True)``), not on every
    read: a filter on a wrapped column can no longer be pushed into the parquet scan."""
    cols = [F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def conformed(df: DataFrame, schema: T.StructType, optional: Collection[str] = ()) -> DataFrame:
    """The columns of ``schema`` in its types; a date that the source holds with its time of day
    stays a timestamp, as periods that aren't truncated depend on it. A column that the source lacks is an error,
    as NULLs in its place would change results (no invoice cancelled, no discount taken), unless it is named in
    ``optional``: then it is NULL."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    out, missing = [], []
    for f in schema.fields:
        kind = kinds.get(f.name.lower())
        if kind is None:
            if f.name not in optional:
                missing.append(f.name)
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif kind == f.dataType or isinstance(f.dataType, T.DateType) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.col(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    if missing:
        raise ValueError(f"the source lacks the columns {', '.join(missing)}; name them as optional to read them as NULL")
    return df.select(*out)


class FinanceTables:
    """Named access to the finance relations (``t.ap_invoices_all`` ...).

    Each relation is created on first use, so a report only plans the scans it needs.
    """

    def __init__(self, loader: Callable[[str], DataFrame] | Mapping[str, DataFrame],
                 layouts: Callable[[str], bool] = lambda table: False):
        if isinstance(loader, Mapping):
            frames = dict(loader)
            loader = frames.__getitem__
        self._loader, self._has_layout = loader, layouts
        self._cache: dict[str, DataFrame] = {}
        # where all documents are hot: salts of the joins of facts, and the facts with many rows of a document
        self.salts, self.heavy = 1, frozenset()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._loaded(name).drop(MONTH)

    def _loaded(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self._loader(name)
            self._cache[name] = df.unionByName(self.hot(name)) if self.is_hot(name) else df
        return self._cache[name]

    def is_hot(self, name: str) -> bool:
        """Whether relation ``name`` has documents that lie apart from its buckets."""
        return self._has_layout(hot_table(name))

    def hot(self, name: str) -> DataFrame:
        return self._loader(hot_table(name))

    def cold(self, name: str) -> DataFrame:
        """Relation ``name`` without the rows of hot documents, in its buckets."""
        return self._loader(name)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def by(self, name: str, key: str) -> DataFrame:
        """Relation ``name`` in the layout bucketed by ``key`` if it was landed in one, else as it is; the columns
        may include a ``key`` that the relation itself lacks."""
        table = layout_table(name, key)
        return self.table(table if self._has_layout(table) else name)

    def in_months(self, name: str, from_date: dt.date | None, to_date: dt.date | None) -> DataFrame:
        """Relation ``name``, of which only the months that the days from ``from_date`` to ``to_date`` (None: open) lie
        in are read where it was landed by month. A superset of the period: the caller filters by its own rule."""
        df = self._loaded(name)
        if MONTH in df.columns:
            if from_date is not None:
                df = df.filter(F.col(MONTH) >= F.lit(from_date.replace(day=1)))
            if to_date is not None:
                df = df.filter(F.col(MONTH) <= F.lit(to_date.replace(day=1)))
        return df.drop(MONTH)

    def derived(self, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        """A DataFrame derived from these tables, built once per key (e.g. the rate
        table of one functional currency) so every use shares one plan."""
        k = ("__derived__", *key)
        if k not in self._cache:
            self._cache[k] = build()
        return self._cache[k]

    def with_overrides(self, **frames: DataFrame) -> "FinanceTables":
        base, has = self._loader, self._has_layout
        # another layout of an overridden relation would hold its former rows
        return FinanceTables(lambda n: frames[n] if n in frames else base(n), lambda table: has(table) and table.split("__")[0] not in frames)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, normalize: bool = False,
                     use_schema: bool = True, optional: Collection[str] = ()) -> "FinanceTables":
        """One parquet file or folder per relation under ``root`` (``<root>/<relation>[.parquet]``). Columns named in
        ``optional`` may be missing and are NULL then; other missing columns are an error.

        ``normalize=True`` turns '' into NULL on read (for sources that were not
        normalised when landed); it costs the predicate pushdown of string filters."""

        def load(name: str) -> DataFrame:
            path = os.path.join(root, name)
            if not os.path.exists(path) and os.path.exists(path + ".parquet"):
                path += ".parquet"
            df = spark.read.parquet(path)
            if use_schema and name in SCHEMAS:
                df = conformed(df, SCHEMAS[name], optional)
            return empty_strings_as_null(df) if normalize else df

        return cls(load)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None,
                     normalize: bool = False) -> "FinanceTables":
        def load(name: str) -> DataFrame:
            df = spark.table(f"{database}.{name}" if database else name)
            return empty_strings_as_null(df) if normalize else df

        return cls(load, lambda table: spark.catalog.tableExists(f"{database}.{table}" if database else table))


__all__ = ["FinanceTables", "empty_strings_as_null", "RELATIONS"]
