"""What several operators share: batch mapping, hashing of code points, and null rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
#: Rows handled at once inside a worker; bounds its memory whatever the Arrow batch size is.
ROWS = 512


def map_rows(df: DataFrame, schema: str, fn: Callable[[dict[str, list]], dict[str, object]]) -> DataFrame:
    """mapInArrow over blocks of at most ROWS rows: ``fn`` gets columns as lists and gives columns back."""

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                got = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                if got is None:
                    continue
                yield pa.RecordBatch.from_arrays([got[f.name] if isinstance(got[f.name], pa.Array) else pa.array(got[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, vectorised; changes ``x`` in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def site_key(domain: str) -> F.Column:
    """Lower case, without a leading ``www.`` and without a port."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.col(domain))), r"^www\.", ""), r":\d+$", "")


def fragments(candidates: DataFrame) -> DataFrame:
    """Candidate fragments in the shape of documents."""
    return candidates.select(F.lit("candidate").alias("record_kind"), F.col("candidate_id").cast("bigint").alias("record_id"), F.col("fragment").alias("text"))


def texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.lit("document").alias("record_kind"), F.col("doc_id").cast("bigint").alias("record_id"), "text")


#: Members that one slice of a group holds at most, on average.
SLICE = 1000


def pairs_within(members: DataFrame, key: str, id_: str, a: str, b: str) -> DataFrame:
    """All pairs ``a`` < ``b`` of members (``key``, ``id_``, distinct rows) of one group, for results that must hold them.

    A group of n members is cut into n / SLICE slices that meet the whole group one by one, so no task holds the pairs
    of a hot group.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key, F.ceil(F.col("_n") / SLICE).cast("int").alias("_slices"))
    sized = members.join(sizes, key)
    left = sized.select(key, F.pmod(F.xxhash64(id_), F.col("_slices")).cast("int").alias("_slice"), F.col(id_).alias(a))
    right = sized.select(key, F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"), F.col(id_).alias(b))
    return left.join(right, [key, "_slice"]).where(F.col(a) < F.col(b)).select(a, b)
