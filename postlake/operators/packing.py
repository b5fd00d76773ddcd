"""Many records an envelope, as producers send them: up to a number of records and
a number of bytes.

Records are packed inside each task, in order: the next envelope ends where the
running sum of bytes, or of records, would pass its limit.  No shuffle, and no
more than one envelope and one batch of rows in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from postlake.operators.decode import to_records

#: What one envelope may hold by default: 500 records, 1 MB.
MAX_RECORDS, MAX_BYTES = 500, 1 << 20
HEAD, TAIL = '{"records":[', "]}"
#: Around each record, and the comma after it.
OPEN, CLOSE = '{"value":', "}"
_EACH = len(OPEN) + len(CLOSE) + 1
SCHEMA = "task int, number long, n_records int, n_bytes long, oversize boolean, value string"


def cuts(sizes: np.ndarray, max_records: int, max_bytes: int, used: int = 0, held: int = 0) -> list[int]:
    """Where envelopes end among records of ``sizes`` bytes, if the open one has
    ``held`` records and ``used`` bytes already.  A record that is too large by
    itself gets an envelope of its own."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    out, start = [], 0
    while start < len(sizes):
        room = int(np.searchsorted(total, total[start] + max_bytes - used, side="right")) - 1
        end = min(room, start + max_records - held)
        if end == start and held == 0:
            end = start + 1
        if end >= len(sizes):
            break  # the open envelope may take more
        out.append(end)
        start, used, held = end, 0, 0
    return out


def pack_envelopes(df: DataFrame, max_records: int = MAX_RECORDS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Rows as ``{"records":[{"value":{…}},…]}`` payloads of at most
    ``max_records`` records and ``max_bytes`` bytes (UTF-8, whole payload).

    Returns ``value``, its ``n_records`` and ``n_bytes``, and ``task`` and
    ``number``, in whose order the records are those of the input's tasks.  A
    record that does not fit by itself is sent alone and marked ``oversize``.
    Nothing is sent for a task without rows.  NULL fields are left out, as in
    :func:`postlake.operators.decode.to_records`; the inverse is
    ``unpack_envelope(..., "records")``.
    """
    if max_records < 1 or max_bytes < 1:
        raise ValueError("an envelope holds a record or more")
    room = max_bytes - len(HEAD) - len(TAIL) + 1  # the last record has no comma

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, used = TaskContext.get().partitionId(), 0, [], 0

        def envelope() -> tuple:
            text = HEAD + ",".join(f"{OPEN}{r}{CLOSE}" for r in held) + TAIL
            size = len(text.encode())
            return task, number, len(held), size, size > max_bytes, text

        for batch in batches:
            records = batch.column(0)
            sizes = pc.binary_length(records.cast(pa.binary())).to_numpy(zero_copy_only=False).astype(np.int64) + _EACH
            texts, start, out = records.to_pylist(), 0, []
            for end in cuts(sizes, max_records, room, used, len(held)):
                held += texts[start:end]
                out.append(envelope())
                start, number, held, used = end, number + 1, [], 0
            held += texts[start:]
            used += int(sizes[start:].sum())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(envelope(), _TYPES)], names=_NAMES)

    return to_records(df).mapInArrow(run, SCHEMA)


_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string()]
