"""Driver lists of documents, fetching their bytes, and landing copies of them."""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow import schemas
from vellumflow.sources.landing import place

# Makes a fetcher in the task: a function from a URL to (status, body).
FetcherFactory = Callable[[], Callable[[str], tuple[int, bytes | None]]]

FETCHED = "struct<status:int,body:binary,error:string>"


def read_driver_list(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and the columns ``document_name, document_url``."""
    return spark.read.schema(schemas.driver_list).option("header", True).csv(path)


def http_fetcher(timeout: float = 60.0) -> FetcherFactory:
    def make():
        def fetch(url: str) -> tuple[int, bytes | None]:
            try:
                with urllib.request.urlopen(url, timeout=timeout) as got:
                    return got.status, got.read()
            except urllib.error.HTTPError as refused:
                return refused.code, None

        return fetch

    return make


def fetch_bytes(docs: DataFrame, factory: FetcherFactory, tasks: int | None = None) -> DataFrame:
    """Add ``status``, ``bytes`` (null unless the status is 200) and ``error``; each URL is fetched once.

    A list of URLs is a small file and so few partitions; ``tasks`` spreads the fetches.
    """

    @F.pandas_udf(FETCHED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fetch = factory()
        for urls in batches:
            rows = []
            for url in urls:
                try:
                    status, body = fetch(url)
                    rows.append((status, body if status == 200 else None, None))
                except Exception as failed:
                    rows.append((None, None, f"{type(failed).__name__}: {failed}"))
            yield pd.DataFrame(rows, columns=["status", "body", "error"], index=urls.index).astype(
                {"status": "Int32", "body": object, "error": object}
            )

    spread = docs.repartition(tasks) if tasks else docs
    return (
        spread.withColumn("_f", run.asNondeterministic()(F.col("document_url")))
        .withColumn("status", F.col("_f.status"))
        .withColumn("bytes", F.col("_f.body"))
        .withColumn("error", F.col("_f.error"))
        .drop("_f")
    )


def landing_path(folder: str, title: Column, suffix: str = ".pdf") -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), title, F.lit(suffix))


def write_files(rows: DataFrame, path: Column, payload: Column, into: str = "downloaded") -> DataFrame:
    """Write ``payload`` to ``path``, on a mounted shared folder or the file system that its scheme names; ``into`` tells whether it was written.

    Rows without bytes are not written. A file appears whole or not at all, so a
    retried task does no harm.
    """

    @F.pandas_udf("boolean")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for paths, bodies in batches:
            done = []
            for target, body in zip(paths, bodies):
                if body is not None and target is not None:
                    place(target, body)
                done.append(body is not None and target is not None)
            yield pd.Series(done, index=paths.index)

    return rows.withColumn(into, run.asNondeterministic()(path, payload))
