"""Column functions over references, pages, keys and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_key(path: Column) -> Column:
    """Document key: md5 of the path string, without the scheme a file scan adds."""
    return F.md5(F.regexp_replace(path, r"^file:(?://(?=/))?", "").cast("binary"))


def output_path(out_dir: str | Column, input_hash: Column) -> Column:
    base = F.lit(out_dir) if isinstance(out_dir, str) else out_dir
    return F.concat_ws("/", base, input_hash)


def image_path(out_dir: str | Column, input_hash: Column, kind: Column, ref: Column) -> Column:
    """Where the image of a page, picture or table is kept."""
    return F.concat_ws("/", output_path(out_dir, input_hash), kind, F.concat(ref_tail(ref), F.lit(".webp")))


def ref_tail(ref: Column) -> Column:
    return F.substring_index(ref, "/", -1)


def unique_pages(pages: Column) -> Column:
    return F.array_sort(F.array_distinct(pages))


def tails_under(refs: Column, kind: str) -> Column:
    """Tails of the references of one kind, e.g. ``tables``."""
    prefix = F.lit(f"#/{kind}/")
    return F.transform(F.filter(refs, lambda r: F.startswith(r, prefix)), ref_tail)


def not_empty(values: Column) -> Column:
    return F.size(values) > 0


def data_url(payload: Column, mime: Column) -> Column:
    """Bytes as a data URL; the line breaks that ``base64`` puts in are removed."""
    encoded = F.regexp_replace(F.base64(payload), "[\r\n]", "")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), encoded)
