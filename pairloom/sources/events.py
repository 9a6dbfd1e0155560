"""Event and product sources: hive-partitioned Parquet with pruning by date and action."""

from __future__ import annotations

import json
import shutil
import tarfile
from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.schemas import empty, require_columns, schema
from pairloom.sources.files import exists, folders, joined, listed


def payload_dir(base: str | Path, names: Sequence[str] = ()) -> str | Path:
    """The first of ``base/name`` that exists, else ``base``; a path in a store is a string."""
    if "://" in str(base):
        found = next((p for p in (*(joined(str(base), n) for n in names), str(base)) if exists(p)), None)
        if found is None:
            raise FileNotFoundError(f"no data under {base}")
        return found
    for name in names:
        if (Path(base) / name).is_dir():
            return Path(base) / name
    if Path(base).is_dir():
        return Path(base)
    raise FileNotFoundError(f"no data under {base}")


def event_dates(events: DataFrame | str) -> list[str]:
    """Dates that have partitions, sorted: the names of a root's folders, or those in a table's list of files; no file is opened."""
    names = folders(events) if isinstance(events, str) else {part for f in events.inputFiles() for part in f.split("/")}
    return sorted(name.partition("=")[2] for name in names if name.startswith("date=") and not name.endswith("=__HIVE_DEFAULT_PARTITION__"))


def filter_dates(available: Iterable[str], dates: Sequence[str] | None = None, start: str | None = None, end: str | None = None, sample_days: int | None = None) -> list[str]:
    """Given dates, or all, within the bounds; then the first few."""
    chosen = [d for d in sorted(set(dates if dates is not None else available)) if (start is None or d >= start) and (end is None or d <= end)]
    if sample_days is not None and sample_days <= 0:
        raise ValueError("sample_days must be positive")
    return chosen[:sample_days] if sample_days is not None else chosen


def scan_events(spark: SparkSession, root: str, dates: Sequence[str] | None = None, start: str | None = None, end: str | None = None, actions: Sequence[str] | None = None, sample_days: int | None = None, columns: Sequence[str] | None = None, validate: bool = True) -> DataFrame:
    """Events of ``root/date=…/action_type=…``; both filters prune partitions, columns reach the scan."""
    df = spark.read.option("basePath", root).parquet(root)
    if validate:
        require_columns(df, "raw_events")
    if dates is not None or start is not None or end is not None or sample_days is not None:
        available = event_dates(root)
        wanted = filter_dates([d for d in available if dates is None or d in dates], None, start, end, sample_days)
        if not wanted:
            raise FileNotFoundError(f"no event partitions under {root} for these dates")
        df = df.filter(F.col("date").cast("string").isin(wanted))
    if actions is not None:
        df = df.filter(F.col("action_type").isin(*actions))
    return df.select(*columns) if columns is not None else df


def load_events(spark: SparkSession, root: str, use_sample: bool = True, sample_days: int = 1, sample_rows: int | None = None, **filters: object) -> DataFrame:
    """A sample by default, the first day; explicit dates turn sampling off. ``sample_rows`` cuts rows."""
    explicit = any(filters.get(k) is not None for k in ("dates", "start", "end"))
    df = scan_events(spark, root, sample_days=sample_days if use_sample and not explicit else None, **filters)  # type: ignore[arg-type]
    return df.limit(sample_rows) if sample_rows is not None else df


def scan_products(spark: SparkSession, root: str, columns: Sequence[str] | None = None, validate: bool = True) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", True).parquet(root)
    if validate:
        require_columns(df, "product_information")
    return df.select(*columns) if columns is not None else df


def scan_or_empty(spark: SparkSession, paths: Sequence[str], contract: str) -> DataFrame:
    """Tables at the paths that exist, or an empty one of the contract."""
    there = [p for p in paths if exists(p)]
    return spark.read.schema(schema(contract)).parquet(*there) if there else empty(spark, contract)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of a tuning sweep."""
    return spark.read.csv(path, header=True, inferSchema=True)


def newest_results(spark: SparkSession, root: str, name: str = "results.csv") -> DataFrame:
    """Results of the sweep below ``root`` that was written last."""
    found = [f for f in listed(root) if f["path"].endswith(f"/{name}")]
    if not found:
        raise FileNotFoundError(f"no {name} under {root}")
    return read_results(spark, max(found, key=lambda f: (f["mtime_ms"], f["path"]))["path"])


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each file. No column is read, so tasks open the files' footers and count from their row groups."""
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def counted_from_footers(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, rows): rows of a table, or of each of its partitions, from the files' footers alone.

    The count is pushed into the scan, which only a source of the second version takes; a session of its own has that
    setting, so that others stay as they are. ``keys`` must be columns of partitions.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("rows"))


def extract_archive(archive: str | Path, target: str | Path, force: bool = False) -> Path:
    """Unpack a tar.gz of data; members that would leave the target are refused, marker files are dropped.

    Work goes to a folder beside the target, so a broken run leaves the target as it was; a finished one leaves a note
    of the archive, and the same archive isn't unpacked again.
    """
    archive, target = Path(archive), Path(target)
    stat = archive.stat()
    mark, note = {"archive": archive.name, "size": stat.st_size, "mtime": int(stat.st_mtime)}, target / ".prepared.json"
    if not force and note.exists() and json.loads(note.read_text()) == mark:
        return target
    stage = target.with_name(target.name + ".staging")
    shutil.rmtree(stage, ignore_errors=True)
    stage.mkdir(parents=True)
    try:
        with tarfile.open(archive, "r:gz") as tar:
            tar.extractall(stage, filter="data")
        for p in stage.rglob("_SUCCESS"):
            p.unlink()
        (stage / note.name).write_text(json.dumps(mark))
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise
    shutil.rmtree(target, ignore_errors=True)
    stage.rename(target)
    return target
