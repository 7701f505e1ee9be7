"""Tables that change together.

Each table has a base and deltas, all of them folders of Parquet by day. A commit is one small file that names the folders
that count, with some values such as markers; readers take the newest commit. What a run wrote without committing is
never read, so that it can stop at any point and simply be run again.

A row's day is a function of its key. So a read merges the base and the deltas of the days it asks for and nothing else,
and compaction rewrites only the days that deltas have touched.

A write of many days puts neighbouring ones into one folder, so that folders and files grow with the rows and not with the
days; the commit says which days lie together, and a read takes of them the days that it asks for.
"""

from __future__ import annotations

import copy
import json
import re
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.sources import files

_COMMITS, _VERSION, _DAY, _PART = "_commits", "commit_version", "store_day", "store_part"
_NONE = "__HIVE_DEFAULT_PARTITION__"  # the name of a day that is null
_FOLDERS = 100  # of one write; with more days than that, neighbours share a folder
_EMPTY = {"version": 0, "values": {}, "tables": {}}


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


@dataclass(frozen=True)
class Keyed:
    """Rows of a table: their columns, their key, what wins of equal keys (SQL, best first), and the key's day (SQL)."""

    schema: str
    key: tuple[str, ...]
    order: tuple[str, ...] = ()
    day: str = "'all'"

    def named_day(self) -> Column:
        return F.coalesce(F.nullif(F.expr(self.day).cast("string"), F.lit("")), F.lit(_NONE))


class Store:
    """Named tables under one root. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Keyed]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables

    def _versions(self) -> list[str]:
        return [n for n in files.names(f"{self.root}/{_COMMITS}") if n.endswith(".json") and not n.startswith(".")]

    def state(self) -> dict:
        """The newest commit, or an empty one: version, values, and of each table base {day: folder} and deltas."""
        found = self._versions()
        return json.loads(files.read(f"{self.root}/{_COMMITS}/{found[-1]}")) if found else copy.deepcopy(_EMPTY)

    def days(self, name: str, state: dict | None = None) -> list[str]:
        t = (state or self.state())["tables"].get(name, {"base": {}, "deltas": []})
        return sorted({*t["base"], *(d for x in t["deltas"] for d in x["days"])})

    def read(self, name: str, since: str | None = None, until: str | None = None, state: dict | None = None, version: bool = False) -> DataFrame:
        """One row for each key, the best one of base and deltas; only folders of the days since .. until are read.

        Of rows that order leaves equal the one of the latest commit wins. version adds commit_version.
        """
        state = state or self.state()
        kept = [d for d in self.days(name, state) if (since is None or d >= since) and (until is None or d <= until)]
        return self._rows(name, state, kept, version)

    def _rows(self, name: str, state: dict, days: list[str], version: bool) -> DataFrame:
        rule = self.tables[name]
        table = state["tables"].get(name, {"base": {}, "deltas": []})
        wanted = set(days)
        touched = {d for x in table["deltas"] for d in x["days"]} & wanted
        still = [(f, d) for d, f in table["base"].items() if d in wanted and d not in touched]
        mixed = [(f, d) for d, f in table["base"].items() if d in touched]
        mixed += [(x["folder"], d) for x in table["deltas"] for d in x["days"] if d in touched]
        schema = f"{rule.schema}, {_VERSION} bigint"
        rows = self._folders(name, table, still) if still else self.spark.createDataFrame([], schema).filter("false")  # read by no task
        if mixed:
            order = [F.expr(o[:-5]).desc() if o.endswith(" desc") else F.expr(o).asc_nulls_last() for o in rule.order]
            w = Window.partitionBy(*rule.key).orderBy(*order, F.desc(_VERSION))
            best = self._folders(name, table, mixed).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
            rows = rows.unionByName(best) if still else best
        return rows if version else rows.drop(_VERSION)

    def _folders(self, name: str, table: dict, pairs: list[tuple[str, str]]) -> DataFrame:
        """Rows of these days of these folders."""
        rule, parts = self.tables[name], table.get("parts", {})
        load = lambda paths: self.spark.read.schema(f"{rule.schema}, {_VERSION} bigint").parquet(*paths)
        alone = [f"{self.root}/{f}/{_DAY}={d}" for f, d in pairs if f not in parts]
        found = [load(alone)] if alone else []
        shared: dict[str, set[str]] = defaultdict(set)
        for f, d in pairs:
            if f in parts:
                shared[f].add(d)
        for f, days in shared.items():
            here = [i for i, together in enumerate(parts[f]) if not days.isdisjoint(together)]
            rows = load([f"{self.root}/{f}/{_PART}={i}" for i in here])
            if not all(days.issuperset(parts[f][i]) for i in here):
                only = self.spark.createDataFrame([(d,) for d in sorted(days)], f"{_DAY} string")
                rows = rows.withColumn(_DAY, rule.named_day()).join(F.broadcast(only), _DAY, "left_semi").drop(_DAY)
            found.append(rows)
        return reduce(DataFrame.unionByName, found)

    def change(self) -> Change:
        return Change(self)

    def compact(self, name: str, least: int = 1) -> None:
        """One commit in which a table of at least so many deltas has none: the days they touched are rewritten."""
        change = self.change()
        if len(change.state["tables"].get(name, {"deltas": []})["deltas"]) >= least:
            change.compact(name)
            change.commit()

    def clean(self, keep: int = 20) -> None:
        """Remove folders that none of the last commits names, and earlier commits. Readers of those must have ended."""
        found = self._versions()
        live: set[str] = set()
        for n in found[-keep:]:
            for t in json.loads(files.read(f"{self.root}/{_COMMITS}/{n}"))["tables"].values():
                live |= {*t["base"].values(), *(x["folder"] for x in t["deltas"])}
        for name in [*self.tables, "scratch"]:
            for folder in files.names(f"{self.root}/{name}"):
                if f"{name}/{folder}" not in live:
                    files.remove(f"{self.root}/{name}/{folder}")
        for n in found[:-keep]:
            files.remove(f"{self.root}/{_COMMITS}/{n}")


class Change:
    """What a run adds; nobody sees it before ``commit``."""

    def __init__(self, store: Store):
        self.store, self.state = store, store.state()
        self.values: dict = self.state["values"]

    def _written(self, name: str, df: DataFrame, days: list[str] | None = None) -> tuple[str, list[str]]:
        """(folder, days) of the rows; days are those that they have, where that is known."""
        rule, folder = self.store.tables[name], f"{name}/{uuid.uuid4().hex}"
        columns = [f.name for f in self.store.spark.createDataFrame([], rule.schema).schema]
        version = F.col(_VERSION) if _VERSION in df.columns else F.lit(self.state["version"] + 1).cast("bigint")
        rows = df.select(*columns, version.alias(_VERSION), rule.named_day().alias(_DAY))
        if days is None:
            days = [] if rule.day == Keyed.day else [r[0] for r in rows.select(_DAY).distinct().collect()]
        if len(days) > _FOLDERS and all(re.fullmatch(r"[\w-]+", d) for d in days):
            return folder, self._together(name, folder, rows, sorted(days))
        rows.hint("rebalance", _DAY).sortWithinPartitions(_DAY, *rule.key).write.partitionBy(_DAY).parquet(f"{self.store.root}/{folder}")
        return folder, [n.partition("=")[2] for n in files.names(f"{self.store.root}/{folder}") if n.startswith(f"{_DAY}=")]

    def _together(self, name: str, folder: str, rows: DataFrame, days: list[str]) -> list[str]:
        size = -(-len(days) // _FOLDERS)
        parts = [days[i : i + size] for i in range(0, len(days), size)]
        part_of = self.store.spark.createDataFrame([(d, i) for i, together in enumerate(parts) for d in together], f"{_DAY} string, {_PART} int")
        placed = rows.join(F.broadcast(part_of), _DAY).hint("rebalance", _PART).sortWithinPartitions(_PART, _DAY, *self.store.tables[name].key)
        placed.drop(_DAY).write.partitionBy(_PART).parquet(f"{self.store.root}/{folder}")
        self._table(name).setdefault("parts", {})[folder] = parts
        return days

    def _table(self, name: str) -> dict:
        return self.state["tables"].setdefault(name, {"base": {}, "deltas": []})

    def append(self, name: str, df: DataFrame) -> None:
        """Rows that are held against those there by key when they are read."""
        folder, days = self._written(name, df)
        if days:
            self._table(name)["deltas"].append({"folder": folder, "days": days})

    def replace(self, name: str, df: DataFrame) -> None:
        folder, days = self._written(name, df)
        table = self._table(name)
        table |= {"base": dict.fromkeys(days, folder), "deltas": []}
        self._forget(table)

    def compact(self, name: str) -> None:
        table = self.state["tables"][name]
        touched = sorted({d for x in table["deltas"] for d in x["days"]})
        if touched:
            folder, days = self._written(name, self.store._rows(name, self.state, touched, True), touched)
            table["base"].update(dict.fromkeys(days, folder))
        table["deltas"] = []
        self._forget(table)

    def _forget(self, table: dict) -> None:
        """Parts of folders that nothing names any more."""
        live = set(table["base"].values())
        if "parts" in table:
            table["parts"] = {f: parts for f, parts in table["parts"].items() if f in live}

    def scratch(self) -> str:
        return f"{self.store.root}/scratch/{uuid.uuid4().hex}"

    def stored(self, df: DataFrame) -> DataFrame:
        """df written beside the tables and read from there, for a run that uses it more than once; ``clean`` removes it."""
        folder = self.scratch()
        df.write.parquet(folder)
        return df.sparkSession.read.schema(df.schema).parquet(folder)

    def commit(self) -> int:
        self.state["version"] += 1
        try:
            files.create(f"{self.store.root}/{_COMMITS}/{self.state['version']:012d}.json", json.dumps(self.state).encode())
        except FileExistsError as e:
            raise Conflict(f"version {self.state['version']} of {self.store.root} is another writer's") from e
        return self.state["version"]
