"""Source aliases, model references and materializations over Spark's own tables.

A ``Catalog`` is a database of the session's catalog whose location is ``root``; its tables are
managed Parquet tables, written with ``saveAsTable`` and ``insertInto`` and dropped, renamed, truncated and
described with Spark's statements. With a metastore they outlive the application.

* ``write_table`` builds the new rows beside the old table and takes its name when they are complete,
  so a table can be rebuilt from its own rows and a failed build leaves it as it was.
* ``append_table`` adds rows in one job; a rerun leaves out the keys that an earlier attempt has added
  (``append_new``), so an append can be repeated.
* Snapshot tables: see ``marquee.sources.snapshots``.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import threading
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.joins import append_new

PROPERTY = "marquee.meta"


class Catalog:
    def __init__(self, spark: SparkSession, root: str, sources: dict | None = None, database: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or "m_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        self.sources: dict[str, object] = dict(sources or {})
        self.models: dict[str, Callable[["Catalog"], DataFrame]] = {}
        self.kinds: dict[str, str] = {}
        location = self.root.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{location}'")

    # ------------------------------------------------------------------ sources
    def source(self, name: str) -> DataFrame:
        """``source('movies', name)``: an alias for a table, a path or a DataFrame."""
        s = self.sources[name]
        if isinstance(s, DataFrame):
            return s
        if isinstance(s, str) and s.isidentifier() and self.exists(s):
            return self.read_table(s)
        return self.spark.read.parquet(s)

    # ------------------------------------------------------------------- models
    def register(self, name: str, fn: Callable[["Catalog"], DataFrame], kind: str = "view") -> None:
        self.models[name] = fn
        self.kinds[name] = kind

    def ref(self, name: str) -> DataFrame:
        """``ref(name)``: a table's stored rows, or a view's (lazy) plan."""
        if self.kinds.get(name, "view") != "view" and self.exists(name):
            return self.read_table(name)
        return self.models[name](self)

    # ------------------------------------------------------------------- tables
    def table(self, name: str) -> str:
        """Full name of a table."""
        return f"{self.database}.{name}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def read_table(self, name: str) -> DataFrame:
        return self.spark.table(self.table(name))

    def write_table(self, name: str, df: DataFrame, meta: dict | None = None) -> DataFrame:
        """Replace a table: the new rows are complete before the old ones go."""
        built = f"{name}__{uuid.uuid4().hex[:12]}"      # a name of its own: late tasks of a failed build may still write to theirs
        try:
            df.write.saveAsTable(self.table(built))
        except Exception:
            self.drop(built)
            raise
        self.drop(name)
        self.spark.sql(f"ALTER TABLE {self.table(built)} RENAME TO {self.table(name)}")
        if meta:
            self.set_meta(name, meta)
        return self.read_table(name)

    def append_table(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows to a table (columns by name), creating it if needed; small partitions are gathered first."""
        if not self.exists(name):
            return self.write_table(name, df)
        columns = self.read_table(name).columns
        df.select(*columns).hint("rebalance").write.insertInto(self.table(name))
        return self.read_table(name)

    def compact(self, name: str) -> DataFrame:
        """Rewrite a table whose appends have left many small files."""
        return self.write_table(name, self.read_table(name).hint("rebalance"), self.meta(name))

    def truncate(self, name: str, df_like: DataFrame | None = None) -> DataFrame:
        """Empty a table (S13); one that does not exist yet is created with the columns of ``df_like``."""
        if not self.exists(name):
            return self.write_table(name, df_like.limit(0))
        self.spark.sql(f"TRUNCATE TABLE {self.table(name)}")
        return self.read_table(name)

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")

    # ----------------------------------------------------------------- metadata
    def meta(self, name: str) -> dict:
        """Values stored with a table (a table property)."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.table(name)}").collect() if self.exists(name) else []
        return next((json.loads(r["value"]) for r in rows if r["key"] == PROPERTY), {})

    def table_meta(self, name: str, field: str):
        return self.meta(name).get(field)

    def set_meta(self, name: str, fields: dict) -> None:
        value = json.dumps({**self.meta(name), **fields}).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {self.table(name)} SET TBLPROPERTIES ('{PROPERTY}' = '{value}')")

    # -------------------------------------------------------- materializations
    def materialize(self, name: str, df: DataFrame, kind: str = "view", key: str | None = None,
                    null_aware: bool = False) -> DataFrame:
        """view: temp view, lazy. table: full rewrite. incremental: append new keys.

        Incremental first run writes everything; later runs append the rows
        whose ``key`` is ``NOT IN`` the stored table (insert-only dimension).
        """
        if kind == "view":
            df.createOrReplaceTempView(name)
            return df
        if kind == "table":
            return self.write_table(name, df)
        if kind == "incremental":
            if not self.exists(name):
                return self.write_table(name, df)
            return self.append_table(name, append_new(df, self.read_table(name), key, null_aware=null_aware))
        raise ValueError(kind)


@contextlib.contextmanager
def overwriting_partitions(spark: SparkSession):
    """Within: an overwriting insert replaces only the partitions it brings rows for. Threads may be within at once: the
    first to enter sets the mode, the last to leave restores it."""
    name = "spark.sql.sources.partitionOverwriteMode"
    with _OVERWRITING:
        if not _WITHIN:
            _WITHIN.append(spark.conf.get(name, "static"))
            spark.conf.set(name, "dynamic")
        _WITHIN.append(None)
    try:
        yield
    finally:
        with _OVERWRITING:
            _WITHIN.pop()
            if len(_WITHIN) == 1:
                spark.conf.set(name, _WITHIN.pop())


_OVERWRITING = threading.Lock()
_WITHIN: list = []          # the mode to restore, then one entry per thread that is within
