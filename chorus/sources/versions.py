"""Versions of a set of tables in one folder, published by manifest.

    root/runs/<run>/<table>/...      what a run wrote, published or not
    root/manifest/version=<n>/...    one row per table of version n

Readers go through the newest manifest only, so a run that is being written,
failed its checks or was lost is never seen, and the version before stays
readable until a later one is published.  A manifest is one small file that
Spark's committer renames into place: it is there whole or not at all.  A
version number is written once (a second writer gets an error) unless the
caller replays it on purpose.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


SCHEMA = "table string, run string, path string, n_rows long"


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    paths: dict[str, str]
    n_rows: dict[str, int]


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, so that any store works."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it is not there."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def version_numbers(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    done = []
    for name in child_names(spark, f"{root}/manifest"):
        if name.startswith("version=") \
                and "_SUCCESS" in child_names(spark, f"{root}/manifest/{name}"):
            done.append(int(name.split("=")[1]))
    return sorted(done)


def read_version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A published version, the newest by default; None when there is none."""
    if number is None:
        known = version_numbers(spark, root)
        if not known:
            return None
        number = known[-1]
    rows = spark.read.schema(SCHEMA).json(f"{root}/manifest/version={number}").collect()
    return Version(number, rows[0].run if rows else "", {r.table: r.path for r in rows},
                   {r.table: r.n_rows for r in rows})      # one row per table


def open_table(spark: SparkSession, root: str, table: str,
               number: int | None = None) -> DataFrame:
    v = read_version(spark, root, number)
    if v is None:
        raise FileNotFoundError(f"no published version in {root}")
    return spark.read.parquet(v.paths[table])


def new_run(root: str) -> tuple[str, str]:
    """(run id, its folder)."""
    run = uuid.uuid4().hex
    return run, f"{root}/runs/{run}"


def publish(spark: SparkSession, root: str, number: int, run: str, paths: Mapping[str, str],
            n_rows: Mapping[str, int], replay: bool = False) -> Version:
    """Write the manifest of version ``number``; from now on readers see it."""
    rows = [(t, run, p, n_rows.get(t)) for t, p in sorted(paths.items())]
    (spark.createDataFrame(rows, SCHEMA).coalesce(1).write
     .mode("overwrite" if replay else "errorifexists")
     .json(f"{root}/manifest/version={number}"))
    return Version(number, run, dict(paths), dict(n_rows))


def clean_up(spark: SparkSession, root: str, keep: int = 2,
             running: tuple[str, ...] = ()) -> list[str]:
    """Remove the folders of lost and failed runs and of versions older than
    the newest ``keep``; returns the run ids.  ``running``: runs that other
    jobs are still writing."""
    known = version_numbers(spark, root)
    held = set(running)
    for n in known[-keep:]:
        v = read_version(spark, root, n)
        held |= {v.run} | {p.rsplit("/runs/", 1)[-1].split("/")[0] for p in v.paths.values()}
    gone = [r for r in child_names(spark, f"{root}/runs") if r not in held]
    for n in known[:-keep]:
        remove(spark, f"{root}/manifest/version={n}")
    for r in gone:
        remove(spark, f"{root}/runs/{r}")
    return gone


