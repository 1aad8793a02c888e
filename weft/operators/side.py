"""Side tables: a table written to the shared checkpoint folder that every task
of another table streams block by block, so neither its size nor its number of
rows ever meets the driver or one task's memory."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from weft.session import scratch_path


def open_folder(path: str):
    """The Arrow file system of a shared folder named by path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    elif path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://") :]
    return fs.FileSystem.from_uri(path)


def write_side(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def side_blocks(path: str, rows: int, cells_col: str | None = None, cells: int = 0) -> Iterator[pa.Table]:
    """The rows of a side table in written order, in blocks of at most ``rows``
    rows and, by running size, ``cells`` elements of the list column
    ``cells_col`` (a single longer row is a block of its own)."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    system, folder = open_folder(path)
    source = ds.dataset(folder, filesystem=system, format="parquet", exclude_invalid_files=True)
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in source.to_batches(batch_size=min(rows, 1024), batch_readahead=1, fragment_readahead=1):
        lengths = pc.fill_null(pc.list_value_length(batch.column(cells_col)), 0).to_pylist() if cells_col else [0] * batch.num_rows
        lo = 0
        for i, more in enumerate(lengths):
            if n and (n >= rows or (cells_col and size + more > cells)):
                held.append(batch.slice(lo, i - lo))
                yield pa.Table.from_batches(held).combine_chunks()
                held, n, size, lo = [], 0, 0, i
            n, size = n + 1, size + more
        if lo < batch.num_rows:
            held.append(batch.slice(lo))
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


#: A worker keeps the prepared blocks of side tables that are a single block.
_KEPT: dict[str, list] = {}


def prepared_blocks(path: str, prepare, rows: int, cells_col: str | None = None, cells: int = 0) -> Iterator:
    """``prepare`` of each block; a one-block table is prepared once per worker."""
    if path in _KEPT:
        yield from _KEPT[path]
        return
    first = None
    for k, block in enumerate(side_blocks(path, rows, cells_col, cells)):
        ready = prepare(block)
        first = ready if k == 0 else None
        yield ready
    if first is not None:
        while len(_KEPT) >= 4:
            _KEPT.pop(next(iter(_KEPT)))
        _KEPT[path] = [first]
