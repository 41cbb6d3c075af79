"""A Python data source for paged title and version APIs, replayed from files.

Live access belongs to an ingest job; the engine reads the pages it stored.
One partition reads one (collection, keyword) scan; filters on collection
are pushed to the choice of partitions.
"""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

from tabularium import schemas
from tabularium.operators.relational import GateError

PAGE = 100


class Scan(InputPartition):
    def __init__(self, folder: str):
        super().__init__(folder)
        self.folder = folder


class PagedReader(DataSourceReader):
    def __init__(self, root: str, fields: list[str]):
        self.root, self.fields, self.collection = root, fields, None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("collection",):
                self.collection = f.value
            yield f  # the filter still applies to the rows

    def partitions(self):
        folders = sorted(p for p in glob.glob(os.path.join(self.root, "*", "*")) if os.path.isdir(p))
        return [Scan(f) for f in folders if self.collection in (None, os.path.basename(os.path.dirname(f)))]

    def read(self, partition):
        seen = set()
        pages = sorted(glob.glob(os.path.join(partition.folder, "*.json")))
        for i, page in enumerate(pages):
            with open(page, encoding="utf-8") as f:
                doc = json.load(f)
            rows = doc.get("value") if isinstance(doc, dict) and "error" not in doc else None
            if not isinstance(rows, list) or (len(rows) < PAGE) != (i == len(pages) - 1):
                raise GateError(f"incomplete scan: {os.path.basename(page)}")
            for r in rows:
                if r["id"] in seen:
                    raise GateError("an id occurs twice in one scan")
                seen.add(r["id"])
                yield tuple(r.get(k) for k in self.fields)


class PagedTitles(DataSource):
    """Through read_paged(spark, root): `<root>/<collection>/<keyword>/<page>.json`.

    A malformed page, a missing last page or an id that occurs twice in one
    scan fails the read; a short page ends a scan.
    """

    @classmethod
    def name(cls):
        return "paged_titles"

    def schema(self):
        return schemas.TITLES

    def reader(self, schema):
        return PagedReader(self.options["path"], [f.name for f in schema.fields])


def read_paged(spark: SparkSession, root: str) -> DataFrame:
    """The stored scans as a table; filters on the collection choose the partitions."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedTitles)
    return spark.read.format("paged_titles").load(root)
