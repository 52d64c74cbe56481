"""What the operators share: tables, text measures, stable random numbers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from logweir.plans.shared import (  # noqa: F401
    clear_runs,
    run_folder,
    shared_dir,
    stored,
    within_bound,
)

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def with_fields(df: DataFrame, **types: str) -> StructType:
    """The schema of ``df`` with further columns."""
    more = [StructField(name, _parse_datatype_string(kind)) for name, kind in types.items()]
    return StructType([*df.schema.fields, *more])


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns of the given names renamed, and its columns as they were.

    For operators that replace older columns of these names, where the caller's own
    are wanted back.
    """
    other = {c: f"aside_{i}_" for i, c in enumerate(df.columns) if c in names}
    back = [F.col(f"`{other.get(c, c)}`").alias(c) for c in df.columns]
    return df.withColumnsRenamed(other), back


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key as one table, from batches in which equal keys adjoin.

    Many short runs come as one table with whole keys; only a run that crosses a
    batch's end is carried over.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if last:
            yield pa.Table.from_batches([*rest, batch.slice(0, last)])
            rest = [batch.slice(last)]
        elif rest and rest[-1].column(key)[0].as_py() != keys[-1]:
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


# --- models fitted on a bounded sample of labelled rows --------------------------


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``per_class`` documents of each label, and all labels' counts.

    Columns doc_id, text, label (0 or 1). Held-out rows are left out. Of a document
    with several labels the larger counts; null labels and ids are ignored. The
    documents with the smallest hashes of their ids are drawn, from the whole table.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    known = stored(known)
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id")
    drawn = known.filter("label = 0").orderBy(order).limit(per_class)
    drawn = drawn.union(known.filter("label = 1").orderBy(order).limit(per_class))
    # At most 2 * per_class ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return sample, counts


def fit_in_task(sample: DataFrame, fit: Callable[[pd.DataFrame], object]) -> object:
    """``fit`` on a bounded sample, in one task; returns the (small) model."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(frames), ignore_index=True)
        frame = frame.sort_values(["doc_id", "text"], kind="stable").reset_index(drop=True)
        yield pd.DataFrame({"model": [pickle.dumps(fit(frame))]})

    one = sample.repartition(1).mapInPandas(run, "model binary").collect()
    return pickle.loads(one[0].model) if one else None
