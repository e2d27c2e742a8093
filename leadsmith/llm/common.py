"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from leadsmith.session import ensure_checkpoint_dir

#: Most entries a per-worker cache of words keeps; words beyond it are worked out again when met.
CACHE_WORDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, as a URI all executors can open."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: work done once, lineage cut."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_by_row(docs: DataFrame, given: dict[str, str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               keep: Iterable[str] = (), at_once: int = 256) -> DataFrame:
    """``fn`` maps frames of the columns ``given`` (name in the frame, column of ``docs``) to frames of ``schema``, one row for each row.

    The columns ``keep`` pass by it, unchanged and in Arrow form, as ``_row_<name>``: a verdict stays on its own row,
    whatever rows share its id, and needs no join.  A column that is given and kept is sent once."""
    keep = list(keep)
    sent = [*dict.fromkeys(c for c in given.values() if c not in keep), *keep]
    n_only = len(sent) - len(keep)
    rows = docs.select(*[docs[c].alias(f"_row_{c}") for c in sent])
    own = T.StructType.fromDDL(schema)
    arrow, at_of = to_arrow_schema(own), {n: sent.index(c) for n, c in given.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                b = whole.slice(at, at_once)
                frame = pd.DataFrame({n: b.column(i).to_pandas() for n, i in at_of.items()})
                made = pa.RecordBatch.from_pandas(fn(frame), schema=arrow, preserve_index=False)
                yield pa.RecordBatch.from_arrays([*made.columns, *b.columns[n_only:]], names=[*arrow.names, *b.schema.names[n_only:]])
    return rows.mapInArrow(run, T.StructType([*own.fields, *rows.schema.fields[n_only:]]))


_held: dict[str, object] = {}


def held(owner: str, make: Callable[[], object]):
    """What one operator keeps in a worker between batches (tokenisers, words met before).

    Workers are reused by later stages: another operator's first call drops what was held and gives the
    memory back, so that a pipeline's worker holds one operator's words at a time."""
    if owner not in _held:
        if _held:
            _held.clear()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
        _held[owner] = make()
    return _held[owner]


def forget(cache: dict, fresh: Iterable, longest: int = 64, most: int = CACHE_WORDS) -> None:
    """Take just added words out again if the cache is full or they are very long (a speed matter only, never of results)."""
    full = len(cache) > most
    for key in fresh:
        if full or len(key) > longest:
            del cache[key]


def blocks(items: list, size: int) -> Iterable[list]:
    return (items[i:i + size] for i in range(0, len(items), size))
