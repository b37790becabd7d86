"""Ordered per-key operators that stay balanced when one key is huge.

``Window.partitionBy(key)`` puts every row of a key into one task; with a key
holding a third of the data that task is the whole job. These helpers cut the
ordering of every *hot* key (more than 1/n of all rows; at most n such keys)
into contiguous chunks of about 1/n of the rows each: fine equal-width buckets
of the leading order column over that key's own range, merged by row count.
Cold keys stay whole. The window runs per ``(key, chunk)`` and the few values
that cross a chunk edge are carried over through a broadcast table with one
row per hot chunk (at most 3n).

Chunk ids are a pure function of the row, so every branch of the plan (and every
retry after a lost executor) agrees on them. A range exchange would not: its
sampled bounds differ between two exchanges of the same data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import shuffle_partitions

_CHUNK = "_seq_chunk"
# Buckets per shuffle partition: enough that a hot key spreads over all tasks.
_CHUNKS_PER_PARTITION = 4
# Fine buckets per planned chunk of a hot key; merged by row count into chunks.
_FINE = 16
# A group smaller than this is never split: one task handles it easily, and
# splitting it would only add work. At large scale total/n is far above it.
MIN_ROWS_PER_CHUNK = 1_000_000


def _as_number(df: DataFrame, name: str) -> Column:
    """Monotone numeric image of an order column."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    return c.cast("double")


def _bucket(x: Column, lo: Column, hi: Column, nb: Column) -> Column:
    """Equal-width bucket of ``x`` in ``[lo, hi]``: 0..nb-1, contiguous in order."""
    width = F.greatest((hi - lo) / nb, F.lit(1e-9))
    return F.least(F.floor((x - lo) / width), nb - 1).cast("long")


def _quantile_chunks(df: DataFrame, x: Column, n: int, min_rows: int) -> DataFrame:
    """One sequence cut at approximate quantiles of its leading order value,
    so every chunk holds about 1/n of the rows however the values cluster.
    The n-1 boundaries (one aggregate, bounded) become literals of a Bucketizer,
    which assigns chunks by binary search on the JVM. NULLs sort first, so
    they join the first chunk."""
    from pyspark.ml.feature import Bucketizer
    xd = df.withColumn("_seq_x", F.coalesce(x.cast("double"), F.lit(float("-inf"))))
    total = df.count()
    n = max(1, min(n, -(-total // min_rows)))
    cuts = []
    if n > 1:
        # One partial aggregate; accuracy 4n keeps each chunk within about a
        # quarter of 1/n of the rows.
        probs = [i / n for i in range(1, n)]
        found = xd.agg(F.percentile_approx("_seq_x", probs, 4 * n)).first()[0]
        cuts = sorted(set(found or []))
    inner = [c for c in cuts if c not in (float("-inf"), float("inf"))]
    if not inner:
        # Small enough for one chunk.
        return df.withColumns({_CHUNK: F.lit(0).cast("long"), "_seq_hot": F.lit(True)})
    splits = [float("-inf")] + inner + [float("inf")]
    chunked = Bucketizer(splits=splits, inputCol="_seq_x", outputCol=_CHUNK).transform(xd)
    return chunked.select(*df.columns, F.col(_CHUNK).cast("long").alias(_CHUNK),
                          F.lit(True).alias("_seq_hot"))


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             chunks: int | None, min_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Add the chunk id and ``_seq_hot``; also return whether any chunking
    happened.

    Without keys the whole frame is one sequence, cut into ``n`` chunks at
    approximate quantiles. With keys only *hot* keys are cut: a key holding
    more than ``total / n`` rows gets ``16 * ceil(count / (total / n))``
    equal-width fine buckets over its own min..max; consecutive fine buckets
    are merged by their row counts into chunks of about ``total / n`` rows.
    Every other key stays whole (chunk 0). The chunks of all hot keys together
    number at most ``3n``.

    Nothing smaller than ``min_rows`` (default ``MIN_ROWS_PER_CHUNK``) counts
    as hot or gets a chunk of its own.
    """
    n = chunks or shuffle_partitions(df.sparkSession) * _CHUNKS_PER_PARTITION
    min_rows = MIN_ROWS_PER_CHUNK if min_rows is None else max(1, min_rows)
    x = _as_number(df, order[0])
    cold = df.withColumns({_CHUNK: F.lit(0).cast("long"), "_seq_hot": F.lit(False)})
    if not keys:
        return _quantile_chunks(df, x, n, min_rows), True
    # One job answers "is any key hot?": rows per key (a partial aggregate),
    # then their sum and maximum.
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_seq_n"))
    total, biggest = per_key.agg(F.sum("_seq_n"), F.max("_seq_n")).first()
    threshold = max(-(-(total or 0) // n), min_rows)
    if biggest is None or biggest <= threshold:
        return cold, False
    # At most n keys can each hold more than total/n rows, so the hot list has
    # a proven bound of n rows: it may reach the driver and be broadcast.
    hot_rows = (df.groupBy(*keys)
                  .agg(F.count(F.lit(1)).alias("_seq_n"), F.min(x).alias("_seq_lo"),
                       F.max(x).alias("_seq_hi"))
                  .where(F.col("_seq_n") > threshold)
                  .select(*[F.col(k).alias(f"_seq_h_{k}") for k in keys], "_seq_lo", "_seq_hi",
                          F.ceil(F.col("_seq_n") / F.lit(threshold)).alias("_seq_nb"))
                  .collect())
    x_type = df.select(x.alias("x")).schema["x"].dataType
    hkeys = [f"_seq_h_{k}" for k in keys]
    hot_schema = T.StructType(
        [T.StructField(f"_seq_h_{k}", df.schema[k].dataType, True) for k in keys]
        + [T.StructField("_seq_lo", x_type, True), T.StructField("_seq_hi", x_type, True),
           T.StructField("_seq_nb", T.LongType(), True)])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_seq_h_{k}"))
        cond = c if cond is None else cond & c
    is_hot = F.col("_seq_lo").isNotNull()
    fine = _bucket(x, F.col("_seq_lo"), F.col("_seq_hi"), F.col("_seq_nb") * _FINE)

    # Rows per fine bucket of every hot key: at most _FINE * 2n counts.
    hot = df.sparkSession.createDataFrame(hot_rows, hot_schema)
    counts: dict[tuple, dict[int, int]] = {}
    for r in (df.join(F.broadcast(hot), cond, "inner")
                .groupBy(*hkeys, fine.alias("_seq_f")).count().collect()):
        counts.setdefault(tuple(r[h] for h in hkeys), {})[r["_seq_f"]] = r["count"]
    # Merge consecutive fine buckets into chunks of about `threshold` rows, so
    # clustered values still give balanced chunks (a single fine bucket above
    # the threshold stays whole). Chunks in total: at most 3n.
    mapped = []
    for r in hot_rows:
        per_fine = counts.get(tuple(r[h] for h in hkeys), {})
        chunk_of, chunk, filled = [], 0, 0
        for f in range(int(r["_seq_nb"]) * _FINE):
            c = per_fine.get(f, 0)
            if filled and filled + c > threshold:
                chunk, filled = chunk + 1, 0
            chunk_of.append(chunk)
            filled += c
        mapped.append(tuple(r) + (chunk_of,))
    hot = df.sparkSession.createDataFrame(
        mapped, T.StructType(hot_schema.fields + [T.StructField("_seq_map", T.ArrayType(T.LongType()))]))
    marked = df.join(F.broadcast(hot), cond, "left")
    chunk = F.when(is_hot, F.element_at(F.col("_seq_map"), (fine + 1).cast("int"))) \
             .otherwise(F.lit(0).cast("long"))
    return marked.select(*df.columns, chunk.alias(_CHUNK), is_hot.alias("_seq_hot")), True


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: Sequence[str], prefix: str = "prev_",
                  chunks: int | None = None, min_rows: int | None = None) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row of the same key.

    ``order`` must be a total order inside a key (end it with a unique column),
    otherwise "previous" is not defined. Rows without a predecessor get NULL.
    """
    ranged, split = _chunked(df, keys, order, chunks, min_rows)
    if not split:
        # No hot key: one balanced window per key is already the right plan.
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in values])
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    local = ranged.select(
        "*",
        F.row_number().over(w).alias("_seq_rn"),
        *[F.lag(v).over(w).alias(f"_seq_p_{v}") for v in values],
    )
    # Last row of every chunk of a hot key: at most 3n rows.
    tails = ranged.where(F.col("_seq_hot")).groupBy(*keys, _CHUNK).agg(
        F.max_by(F.struct(*[F.col(v).alias(f"_seq_v_{v}") for v in values]), F.struct(*order))
        .alias("_seq_last"))
    carry = tails.select(
        *[F.col(k).alias(f"_seq_k_{k}") for k in keys], F.col(_CHUNK).alias("_seq_c"),
        F.lag("_seq_last").over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias("_seq_carry"))
    carry = carry.where(F.col("_seq_carry").isNotNull())
    cond = F.col(_CHUNK) == F.col("_seq_c")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_seq_k_{k}"))
    # Bounded by the 3n chunks of hot keys, so the big side is never re-shuffled.
    joined = local.join(F.broadcast(carry), on=cond, how="left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_seq_rn") == 1, F.col(f"_seq_carry._seq_v_{v}"))
           .otherwise(F.col(f"_seq_p_{v}")).alias(prefix + v) for v in values])


def with_running_max(df: DataFrame, order: Sequence[str], value: str,
                     out: str = "running_max", chunks: int | None = None,
                     min_rows: int | None = None) -> DataFrame:
    """Add ``out`` = max of ``value`` over all rows up to and including this one
    in the global ``order`` (a single sequence: the worst case for one task).

    The sequence is cut at quantiles of its leading order value; each chunk
    computes its local running max, and the prefix max of the earlier chunks
    (one row per chunk, so at most ``chunks`` rows) is broadcast back.
    """
    ranged, _ = _chunked(df, [], order, chunks, min_rows)
    w = (Window.partitionBy(_CHUNK).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_seq_local", F.max(value).over(w))
    per_chunk = ranged.groupBy(_CHUNK).agg(F.max(value).alias("_seq_cmax"))
    before = per_chunk.select(
        F.col(_CHUNK).alias("_seq_c"),
        F.max("_seq_cmax").over(Window.orderBy(_CHUNK).rowsBetween(
            Window.unboundedPreceding, -1)).alias("_seq_prefix"))
    joined = local.join(F.broadcast(before), F.col(_CHUNK) == F.col("_seq_c"), "left")
    return joined.select(
        *df.columns,
        F.greatest(F.col("_seq_local"), F.col("_seq_prefix")).alias(out))


__all__ = ["with_previous", "with_running_max"]
