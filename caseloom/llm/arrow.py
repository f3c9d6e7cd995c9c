"""Arrow batches in tasks: bounded pieces in, the same rows with more columns out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECE_CHARS = 1_000_000
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow`` with batches of some ``BATCH_BYTES``, or one row.

    Executor and worker both hold a batch, and by default ten thousand texts are one.
    The session keeps the bound, which changes no result; one that is set already stands.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, None) is None:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def pieces(batch: pa.RecordBatch, column: str, chars: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a piece holds some ``chars`` characters of text, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def with_columns(
    df: DataFrame,
    text: str,
    added: Sequence[tuple[str, T.DataType]],
    start: Callable[[], Callable[[list[str | None]], Sequence[pa.Array]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` and columns made from ``text``, a piece of an Arrow batch at a time.

    ``start`` runs once in a task and returns the function from texts to one array
    per added column. ``keep`` names the columns of ``df`` to return, all by
    default; those whose names are added are replaced.
    """
    names = [n for n, _ in added]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    need = list(dict.fromkeys([*kept, text]))
    schema = T.StructType(
        [df.schema[c] for c in kept] + [T.StructField(n, t) for n, t in added]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for piece in pieces(batch, text):
                made = work(piece.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in kept), *made], names=[*kept, *names]
                )

    return map_batches(df.select(*[f"`{c}`" for c in need]), run, schema)
