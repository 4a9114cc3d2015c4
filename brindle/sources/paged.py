"""Paged JSON listings that a crawl has landed as files, as a Spark data source: a partition reads a range of one source's pages.

Pages lie at ``path/source=<name>/page=<number>/``, one JSON document in the files of each. A listing is read from page 1 to its first short page (fewer items than a full one, none, or a page
that is missing or does not parse). A partition stops at the first such page of its own range; which page ends the whole listing is then an aggregate over page reports, so ranges need not wait for each other.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "source string, page int, status string, n_items int, sha256 string, place int, item string"


class PageRange(InputPartition):
    def __init__(self, source: str, folder: str, first: int, last: int) -> None:
        self.source, self.folder, self.first, self.last = source, folder, first, last


class PagedJson(DataSource):
    """Options: path, items (field that holds the list), page_size, last_page, pages_per_task.

    A row for each item, and one without place and item for each page that has none. Items are JSON texts, parsed by Spark where a schema is known.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self.options)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return fs.LocalFileSystem(), path


class PagedReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.items = options["path"].rstrip("/"), options.get("items", "products")
        self.size, self.last_page, self.each = (int(options.get(k, d)) for k, d in (("page_size", 250), ("last_page", 20), ("pages_per_task", 5)))
        if min(self.size, self.last_page, self.each) < 1:
            raise ValueError("page_size, last_page and pages_per_task count from 1")

    def partitions(self) -> list[InputPartition]:
        """Ranges of pages of each source folder up to the first page that is missing; names only are listed here."""
        store, root = _store(self.path)
        folders = lambda where: {f.base_name for f in store.get_file_info(fs.FileSelector(where, allow_not_found=True)) if f.type == fs.FileType.Directory}
        out: list[InputPartition] = []
        for s in sorted(f for f in folders(root) if f.startswith("source=")):
            there = folders(f"{root}/{s}")
            last = next((p for p in range(1, self.last_page) if f"page={p}" not in there), self.last_page)
            out += [PageRange(unquote(s[7:]), s, p, min(p + self.each - 1, last)) for p in range(1, last + 1, self.each)]
        return out

    def _page(self, store: fs.FileSystem, folder: str) -> tuple[str, str | None, list]:
        """Status, hash of the bytes and items of one page."""
        files = [f for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        if not files:
            return "missing", None, []
        body = b""
        for f in sorted(files, key=lambda f: f.path):
            with store.open_input_stream(f.path) as stream:
                body += stream.read()
        digest = hashlib.sha256(body).hexdigest()
        try:
            items = json.loads(body)[self.items]
        except (ValueError, KeyError, TypeError):
            return "malformed", digest, []
        return ("ok", digest, items) if isinstance(items, list) else ("malformed", digest, [])

    def read(self, partition: PageRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no source folder
            return
        store, root = _store(self.path)
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string()]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for page in range(partition.first, partition.last + 1):
            status, digest, items = self._page(store, f"{root}/{partition.folder}/page={page}")
            n = max(1, len(items))
            texts = [json.dumps(i, ensure_ascii=False, separators=(",", ":")) for i in items] or [None]
            columns = [[partition.source] * n, [page] * n, [status] * n, [len(items)] * n, [digest] * n, list(range(1, len(items) + 1)) or [None], texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            if status != "ok" or len(items) < self.size:
                return


def listing(spark: SparkSession, path: str, page_size: int = 250, last_page: int = 20, pages_per_task: int = 5, items: str = "products") -> DataFrame:
    """source, page, status, n_items, sha256, place, item of each source's pages up to the one that ends it. No folder gives no rows."""
    spark.dataSource.register(PagedJson)
    rows = spark.read.format("paged_json").options(path=path, page_size=page_size, last_page=last_page, pages_per_task=pages_per_task, items=items).load()
    ends = rows.where((F.col("status") != "ok") | (F.col("n_items") < page_size)).groupBy("source").agg(F.min("page").alias("_end"))
    return rows.join(ends, "source", "left").where(F.col("_end").isNull() | (F.col("page") <= F.col("_end"))).drop("_end")


def items_of(listed: DataFrame, schema: StructType | str) -> DataFrame:
    """The items as columns of ``schema``, with source, page, place and the page's sha256."""
    rows = listed.where("item is not null").select("source", "page", "place", "sha256", F.from_json("item", schema).alias("r"))
    return rows.select("source", "page", "place", "sha256", "r.*")


def source_report(listed: DataFrame) -> DataFrame:
    """source, status (ok, partial: some pages failed, unavailable: all did), pages, n_items."""
    pages = listed.groupBy("source", "page").agg(F.first("status").alias("status"), F.first("n_items").alias("n"))
    ok = F.count_if(F.col("status") == "ok")
    state = F.when(ok == F.count(F.lit(1)), "ok").when(ok > 0, "partial").otherwise("unavailable")
    return pages.groupBy("source").agg(state.alias("status"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n_items"))


def land_pages(df: DataFrame, path: str, source: str, order: str, item: str, page_size: int, items: str = "products") -> None:
    """Write rows as the pages of a listing: the counterpart of ``listing``. ``item`` is a struct or JSON text column; a page is one row of at most ``page_size`` items."""
    dealt = df.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(order)) - 1).withColumn("page", F.floor(F.col("_n") / page_size).cast("int") + 1)
    text = F.col(item) if dict(df.dtypes)[item] == "string" else F.to_json(item)
    pages = dealt.groupBy(F.col(source).alias("source"), "page").agg(F.array_sort(F.collect_list(F.struct("_n", text.alias("t")))).alias("r"))
    body = F.concat(F.lit(json.dumps({items: 0})[:-2] + "["), F.array_join(F.transform("r", lambda x: x["t"]), ","), F.lit("]}"))
    pages.select("source", "page", body.alias("value")).write.partitionBy("source", "page").text(path)
