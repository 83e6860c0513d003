"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised; a table's key is ``projections`` values
floor((a.v + b) / width) with Gaussian a, for ``tables`` tables.  Vectors that
share a key and their label are compared by cosine in double precision, in
blocks by matrix products.  With the defaults, a pair at cosine 0.93 meets in a
table with probability 0.26, in one of the 16 with 0.99.

Equal vectors of a label are one class before anything is hashed; their links
are counted from the class size.  A bucket of more than ``block`` classes is
dealt into blocks and each pair of blocks is a task's unit, so that no task
holds a whole hot bucket.  A pair counts in the first table where it meets, and
only sums and one link per row and block leave the kernel, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan_tasks, stored
from .graph import components

THRESHOLD, TABLES, PROJECTIONS, WIDTH, BLOCK, SEED = 0.93, 16, 6, 1.5, 1024, 11


def _keys(vectors: np.ndarray, tables: int, projections: int, width: float) -> np.ndarray:
    """One 64-bit key a table for each row of normalised vectors."""
    from .hashing import spans_hash

    rng = np.random.default_rng([SEED, vectors.shape[1]])
    a = rng.standard_normal((vectors.shape[1], tables * projections))
    b = rng.uniform(0, width, tables * projections)
    cells = np.floor((vectors @ a + b) / width).astype(np.int64).reshape(len(vectors), tables, projections)
    flat = cells.reshape(-1).view(np.uint64)
    start = np.arange(0, len(flat), projections)
    return spans_hash(flat, start, start + projections).reshape(len(vectors), tables).view(np.int64)


def _hashed(tables: int, projections: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pdf = batch.to_pandas()
            sizes = pdf["vector"].map(len)
            for dim, part in pdf.groupby(sizes):
                x = np.stack(part["vector"].to_numpy()).astype(np.float64).reshape(len(part), dim)
                keys = _keys(x / np.linalg.norm(x, axis=1, keepdims=True), tables, projections, width)
                for t in range(tables):
                    yield pa.RecordBatch.from_pydict({
                        "label": part["label"].to_numpy(), "dim": np.full(len(part), dim, np.int32), "t": np.full(len(part), t, np.int32), "key": keys[:, t],
                        "id": part["id"].to_numpy(), "copies": part["copies"].to_numpy(),
                        "keys": pa.array([k.tobytes() for k in keys], pa.binary()), "vec": pa.array([v.tobytes() for v in x], pa.binary()),
                    })
    return run


def _linked(threshold: float, block: int):
    def unit(t: int, pdf: pd.DataFrame) -> pd.DataFrame | None:
        if len(pdf) < 2:
            return None
        x = np.stack([np.frombuffer(v) for v in pdf["vec"]])
        keys = np.stack([np.frombuffer(k, np.int64) for k in pdf["keys"]])
        ids, copies, side = pdf["id"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy()
        norm = np.linalg.norm(x, axis=1)
        i, j = [], []
        # A unit is one block against itself (side 0 alone) or one block (0) against another (1).
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        pair = len(right) > 0
        if pair and not len(left):
            return None
        right = right if pair else left
        for lo in range(0, len(left), block):
            rows = left[lo : lo + block]
            cos = (x[rows] @ x[right].T) / (norm[rows][:, None] * norm[right][None, :])
            a, b = np.nonzero(cos >= threshold)
            a, b = rows[a], right[b]
            if not pair:
                a, b = a[a < b], b[a < b]
            new = ~(keys[a, :t] == keys[b, :t]).any(axis=1) if t else np.ones(len(a), bool)
            i.append(a[new])
            j.append(b[new])
        i, j = np.concatenate(i), np.concatenate(j)
        if not len(i):
            return None
        n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        # Spread the smallest id over this unit's links until nothing changes: one link a row leaves.
        low = ids.copy()
        while True:
            before = low.copy()
            np.minimum.at(low, i, before[j])
            np.minimum.at(low, j, before[i])
            if (low == before).all():
                break
        return pd.DataFrame({"id": ids, "n": n.astype(np.int64), "low": low})[n > 0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        unit_key = ["label", "dim", "t", "key", "lo", "hi"]
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            change = (pdf[unit_key] != pdf[unit_key].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(change)
            out = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a > 1 and (got := unit(int(pdf["t"].iat[a]), pdf.iloc[a:b])) is not None:
                    out.append(got)
            rest = pdf.iloc[starts[-1] :] if len(starts) else None
            if out:
                yield pd.concat(out)
        if rest is not None and len(rest) > 1 and (got := unit(int(rest["t"].iat[0]), rest)) is not None:
            yield got
    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (long), component_id (long), kept (boolean).

    Needs vec_id, embedding (array of numbers) and label (of any type); other
    columns are not read.  Vectors link if their
    labels are equal and not null, they have as many components, and their
    cosine is at least ``threshold``; n_links counts the other rows linked
    directly.  Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null label or id, link with nothing: n_links 0,
    component_id their own vec_id, kept true (null id: null and false).  Repeated rows
    count as rows of their own; kept holds for every row with the smallest id.
    """
    spark = vectors.sparkSession
    base = vectors.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"), "label")  # -0.0 becomes 0.0
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.expr("size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf')) and exists(vector, x -> x <> 0)")
    base = base.withColumn("fine", F.coalesce(fine, F.lit(False)))
    classes = base.where("fine").groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    # Two rows of a class may share the smallest id with another label's class; the class key keeps them apart.
    classes = stored(classes.select("label", "vector", "copies", F.col("id").alias("vec_id")).withColumn("id", F.xxhash64("label", "vector")), "classes")
    schema = "label long, dim int, t int, key long, id long, copies long, keys binary, vec binary"
    rows = classes.select(F.xxhash64("label").alias("label"), "vector", "id", "copies").mapInArrow(_hashed(tables, projections, width), schema)
    bucket = ["label", "dim", "t", "key"]
    sizes = rows.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1").withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    met = rows.join(sizes, bucket).withColumn("own", F.pmod(F.col("id"), F.col("parts")).cast("int"))
    unit = F.explode(F.expr("transform(sequence(0, parts - 1), p -> struct(least(p, own) as lo, greatest(p, own) as hi, if(own > p, 1, 0) as side))"))
    met = met.select(*bucket, "id", "copies", "keys", "vec", unit.alias("u")).select(*bucket, "u.lo", "u.hi", "u.side", "id", "copies", "keys", "vec")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), scan_tasks(classes, 4096))
    met = met.repartition(n, *bucket, "lo", "hi").sortWithinPartitions(*bucket, "lo", "hi")
    found = stored(met.mapInPandas(_linked(threshold, block), "id long, n long, low long"), "near")
    linked = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    per_class = classes.select("id", "copies", "vec_id").join(counts, "id", "left").join(linked, "id", "left").withColumn("component", F.coalesce("component_id", "id"))
    per_class = stored(per_class.select("id", "vec_id", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classed")
    smallest = per_class.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    per_class = per_class.join(smallest, "component").select("id", "n_links", "component_id")
    out = base.select("vec_id", F.when(F.col("fine"), F.xxhash64("label", "vector")).alias("id")).join(per_class, "id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
