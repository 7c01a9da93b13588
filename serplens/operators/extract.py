"""Metadata extraction from landed HTML, one pass per page and no shuffle.

Rows are parsed where they are read; HTML never leaves its partition. Python
sees only the pages worth parsing, in Arrow batches, and hands back narrow rows,
a few pages at a time: memory follows one batch of input, not what is found in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serplens import schemas
from serplens.operators import page_reader

cloudpickle.register_pickle_by_value(page_reader)

#: Characters of HTML after which what was found in them is handed back.
SLICE_CHARS = 1 << 20
#: Pages after which it is, however short they are.
SLICE_PAGES = 256

_STRING_LIST = pa.list_(pa.string())
_ARROW_TYPES = {
    "alternates": pa.list_(pa.struct([("href", pa.string()), ("hreflang", pa.string())])),
    "schema_json_ld": _STRING_LIST,
    "h1": _STRING_LIST,
}
_ARROW_META = pa.schema([
    (name, _ARROW_TYPES.get(name, pa.string())) for name in schemas.META_VALUES.names
])


def _batch_parser(meta_schema: pa.Schema):
    """Arrow function that replaces ``html`` by the metadata found in it."""
    read_page = page_reader.read_page

    def narrow(pages: pa.RecordBatch, status: list, found: list[dict]) -> pa.RecordBatch:
        kept = [c for c in pages.schema.names if c not in ("html", "status", "error")]
        meta = pa.RecordBatch.from_pylist(found, schema=meta_schema)
        return pa.RecordBatch.from_arrays(
            [pages.column(c) for c in kept] + [pa.array(status, pa.int32())] + meta.columns,
            names=[*kept, "status", *meta.schema.names],
        )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, errors = batch.column("html"), batch.column("error")
            first, chars, status, found = 0, 0, [], []
            for i, code in enumerate(batch.column("status")):
                status.append(code.as_py())
                if html[i].is_valid:
                    try:
                        text = html[i].as_py()
                        chars += len(text)
                        found.append(read_page(text))
                    except Exception as failure:  # one bad page must not fail the job
                        status[-1] = 0
                        found.append({"error": f"{type(failure).__name__}: {failure}"})
                else:
                    found.append({"error": errors[i].as_py()})
                if chars >= SLICE_CHARS or len(found) == SLICE_PAGES or i + 1 == batch.num_rows:
                    yield narrow(batch.slice(first, len(found)), status, found)
                    first, chars, status, found = i + 1, 0, [], []

    return parse


def extract_metadata(raw_pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Metadata of landed pages; every other column is passed through.

    ``partitions`` deals the pages out anew before they are parsed, for landed
    files too few to keep all cores busy; it shuffles their HTML and is off by default.

    Only pages fetched with status 200 are parsed. Others carry an error: the
    transport message for status 0, ``HTTP n`` otherwise.
    """
    if partitions:
        raw_pages = raw_pages.repartition(partitions)
    ok = F.col("status") == 200
    gated = raw_pages.withColumns({
        "status": F.col("status").cast("int"),
        "html": F.when(ok, F.coalesce("html", F.lit(""))),
        "error": F.when(ok, F.lit(None).cast("string"))
        .when(F.col("status") == 0, F.coalesce("error", F.lit("")))
        .otherwise(F.concat(F.lit("HTTP "), F.col("status"))),
    })
    kept = [f for f in gated.schema.fields if f.name not in ("html", "status", "error")]
    out = T.StructType([*kept, T.StructField("status", T.IntegerType()), *schemas.META_VALUES.fields])
    return gated.mapInArrow(_batch_parser(_ARROW_META), out)


def latest_per_path(pages: DataFrame, fetched: str | None = "fetched_at") -> DataFrame:
    """The last result of each path; without a column to tell, a successful one.

    Meant for extracted rows: repeated fetches are cheaper to parse twice than
    to shuffle as HTML. Only one row per path and partition is shuffled.
    """
    # Of fetches at the same time a successful one counts, then one that is the same in every run.
    whole = F.xxhash64(*(c for c in pages.columns if c not in ("path", fetched)))
    last = [F.desc(fetched)] if fetched else []
    order = Window.partitionBy("path").orderBy(*last, F.desc(F.col("status") == 200), whole)
    return pages.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == 1).drop("_nth")
