"""Which files a table consists of: manifests that are switched last.

A table's root holds ``version=<id>`` folders, each written once by one job, and small
numbered manifests that name, for every partition, the versions that hold its rows. A write
goes to a new version; readers see it when the next manifest is there, whole or not at all.
A job that is killed before leaves the table as it was. Of two jobs that end one after the
other the later builds on the manifest of the earlier; two that end at the same moment cannot
both write the next number, and one fails. That needs a file system whose rename does not
overwrite; on a store without one, a table has one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from visitfold.sources.files import Folder

MANIFESTS = "_manifests"
VERSION = "version"
# Fixed value: what Spark names the folder of rows without a partition value.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    number: int
    columns: str
    partition_by: tuple[str, ...]
    places: dict[str, tuple[str, ...]]
    loads: tuple[str, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @property
    def versions(self) -> set[str]:
        return {version for versions in self.places.values() for version in versions}

    def within(self, since: str | None, until: str | None) -> dict[str, tuple[str, ...]]:
        """Places of days from ``since`` up to and including ``until``."""
        if since is None and until is None:
            return dict(self.places)
        return {
            place: versions
            for place, versions in self.places.items()
            if (day := day_of(place)) and day != NO_DAY and (since or day) <= day <= (until or day)
        }


def day_of(place: str) -> str | None:
    """The day of a partition's folder, ``NO_DAY`` for rows without one, null for other tables."""
    for part in place.split("/"):
        name, _, value = part.partition("=")
        if name == "event_date":
            return value
    return None


def _file(number: int) -> str:
    return f"{number:012d}.json"


def _numbers(folder: Folder) -> list[int]:
    names = folder.names()
    return [int(name.removesuffix(".json")) for name in names if name[:1].isdigit() and name.endswith(".json")]


def _parsed(text: str) -> Manifest:
    found = json.loads(text)
    found["partition_by"], found["loads"] = tuple(found["partition_by"]), tuple(found["loads"])
    found["places"] = {place: tuple(versions) for place, versions in found["places"].items()}
    return Manifest(**found)


def latest(spark: SparkSession, path: str) -> Manifest | None:
    folder = Folder(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    numbers = _numbers(folder)
    return _parsed(folder.read(_file(max(numbers)))) if numbers else None


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    Folder(spark, f"{path.rstrip('/')}/{MANIFESTS}").create(_file(manifest.number), manifest.text())


def new_version() -> str:
    return f"{VERSION}={uuid.uuid4().hex}"


def _written(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders of a version; the version itself if the table has none."""
    places = [""]
    for _ in range(depth):
        places = [
            f"{place}/{name}".lstrip("/")
            for place in places
            for name in Folder(spark, f"{folder}/{place}").names()
            if "=" in name
        ]
    return places


def successor(
    spark: SparkSession,
    path: str,
    before: Manifest | None,
    version: str,
    schema: T.StructType,
    partition_by: tuple[str, ...],
    keep: dict[str, tuple[str, ...]],
    add: bool,
    load: str | None,
) -> Manifest:
    """The manifest after a version was written: its places replace, or extend, those that are kept."""
    places = dict(keep)
    for place in _written(spark, f"{path.rstrip('/')}/{version}", len(partition_by)):
        places[place] = (*places.get(place, ()), version) if add else (version,)
    loads = () if before is None else before.loads
    return Manifest(
        0 if before is None else before.number + 1,
        schema.json(),
        tuple(partition_by),
        places,
        (*loads, load) if load else loads,
    )


def read(
    spark: SparkSession, path: str, manifest: Manifest, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The rows of a manifest's places; folders of other days are not listed."""
    schema = T.StructType.fromJson(json.loads(manifest.columns))
    root = path.rstrip("/")
    paths = [
        f"{root}/{version}/{place}".rstrip("/")
        for place, versions in manifest.within(since, until).items()
        for version in versions
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(stored).option("basePath", root).parquet(*paths).select(*schema.names)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` manifests and delete versions that only others name.

    What a running job has written and not yet named stays. Returns the deleted versions.
    """
    folder = Folder(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    numbers = _numbers(folder)
    old, kept = numbers[:-keep], numbers[-keep:]
    versions = lambda some: {v for n in some for v in _parsed(folder.read(_file(n))).versions}
    gone = sorted(versions(old) - versions(kept))
    for number in old:
        folder.delete(_file(number))
    for version in gone:
        Folder(spark, path).delete(version)
    return gone


def without(manifest: Manifest, since: str | None, until: str | None) -> dict[str, tuple[str, ...]]:
    """Places outside of a span of days."""
    inside = manifest.within(since, until)
    return {place: versions for place, versions in manifest.places.items() if place not in inside}


def unloaded(manifest: Manifest) -> Manifest:
    """The manifest as a table that is replaced leaves it behind: no load counts any more."""
    return replace(manifest, loads=())


def renumbered(manifest: Manifest, **changes) -> Manifest:
    """The next manifest with other contents and the same files."""
    return replace(manifest, number=manifest.number + 1, **changes)
