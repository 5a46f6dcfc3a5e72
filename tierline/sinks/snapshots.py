"""Keyed tables: conforming rows to a target's schema, and the keyed upsert.

Both are DataFrame in, DataFrame out; :mod:`tierline.sinks.target` writes the
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.enrich import fits_broadcast
from ..operators.keys import assert_no_null_keys, assert_unique

IN_STAGED = "__in_staged"
IN_TARGET = "__in_target"
STAGED_PREFIX = "__s_"


def evolve(
    df: DataFrame,
    schema: StructType,
    defaults: dict | None = None,
    now_columns: tuple[str, ...] = (),
    keep_extra: bool = True,
) -> DataFrame:
    """Conform ``df`` to ``schema``: every target column in target order and
    type; missing ones are added with their default (``now_columns`` get the
    current time, others null). Columns outside the schema are kept at the
    end unless ``keep_extra`` is False."""
    defaults = defaults or {}
    present = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name in now_columns:
            cols.append(F.current_timestamp().cast(field.dataType).alias(field.name))
        elif field.name in defaults:
            cols.append(F.lit(defaults[field.name]).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    if keep_extra:
        names = {f.name for f in schema.fields}
        cols.extend(F.col(c) for c in df.columns if c not in names)
    return df.select(*cols)


def upsert(
    target: DataFrame,
    staged: DataFrame,
    key: str,
    stamp: str | None = "last_updated_at",
    defaults: dict | None = None,
    validate: bool = True,
    broadcast_max_rows: int | None = None,
    broadcast_max_bytes: int = 256 * 1024 * 1024,
) -> DataFrame:
    """Insert staged rows; on key conflict replace the staged columns.

    * columns present in ``staged`` are replaced (not added to) for matching
      keys; other target columns keep their values;
    * target rows without a staged row survive unchanged;
    * new keys are inserted, target-only columns get ``defaults`` (else null);
    * ``stamp`` is set to now on every inserted or replaced row.

    Two plans with the same result:

    * staged keys within ``broadcast_max_rows`` / ``broadcast_max_bytes``
      (measured, see ``fits_broadcast``): the staged keys are broadcast; the
      target is split by a broadcast anti join (survivors) and a broadcast
      semi join (rows being replaced), so the target is never shuffled: the
      right plan when a micro-batch touches few keys of a large target (for
      a small target it costs about the same as the join: a size probe and a
      second target scan instead of a small shuffle);
    * otherwise one full outer join on the key: both sides are shuffled once.

    ``validate`` refuses null or repeated staged keys before anything is
    computed.
    """
    defaults = defaults or {}
    if validate:
        assert_no_null_keys(staged, key, what="staged rows")
        assert_unique(staged, key, what="staged rows")
    staged_cols = [c for c in staged.columns if c != key]
    target_cols = [c for c in target.columns if c != key]
    s = staged.select(
        F.col(key),
        *[F.col(c).alias(STAGED_PREFIX + c) for c in staged_cols],
        F.lit(True).alias(IN_STAGED),
    )
    t = target.withColumn(IN_TARGET, F.lit(True))
    small = broadcast_max_rows is not None and fits_broadcast(
        staged.select(key), broadcast_max_rows, broadcast_max_bytes
    )
    joined = _split_by_staged_keys(t, s, key) if small else t.join(s, on=key, how="full_outer")
    in_staged = F.coalesce(F.col(IN_STAGED), F.lit(False))
    in_target = F.coalesce(F.col(IN_TARGET), F.lit(False))
    out = [F.col(key)]
    for c in target_cols:
        if c == stamp:
            out.append(F.when(in_staged, F.current_timestamp()).otherwise(F.col(c)).alias(c))
        elif c in staged_cols:
            out.append(F.when(in_staged, F.col(STAGED_PREFIX + c)).otherwise(F.col(c)).alias(c))
        elif c in defaults:
            fill = F.lit(defaults[c]).cast(target.schema[c].dataType)
            out.append(F.when(in_target, F.col(c)).otherwise(fill).alias(c))
        else:
            out.append(F.col(c))
    for c in staged_cols:
        if c not in target_cols:
            out.append(F.col(STAGED_PREFIX + c).alias(c))
    if stamp and stamp not in target_cols:
        out.append(F.when(in_staged, F.current_timestamp()).alias(stamp))
    return joined.select(*out)


def _split_by_staged_keys(t: DataFrame, s: DataFrame, key: str) -> DataFrame:
    """The full outer join of ``t`` and ``s`` on ``key``, computed without
    shuffling ``t``: ``s`` (few keys) is broadcast to split ``t``."""
    keys = F.broadcast(s.select(key))
    survivors = t.join(keys, on=key, how="left_anti")
    replaced = t.join(keys, on=key, how="left_semi")
    staged_side = s.join(replaced, on=key, how="left")
    return survivors.unionByName(staged_side, allowMissingColumns=True)
