"""Change application: upsert, SCD1, sequenced CDC, SCD2, change feed.

All operators are lazy DataFrame → DataFrame functions; none collects rows.

Scale notes
- A merge meets target and source in one join; whether a side is broadcast
  or sorted is Spark's choice. An upsert of rows with the target's columns
  is an anti join on the batch's keys alone, which a small batch broadcasts;
  its change images are a left join from the batch. Where rows and images
  are both wanted, one full outer join emits both.
- Rows whose key has a NULL part never match (trap T17), but a join would
  still hash them all to one partition. The join therefore has one more
  column, which is 0 for complete keys and a hash of the row for the others,
  so a flood of NULL keys is spread over all partitions.
- Duplicate source keys are detected with a count over a window
  partitioned by the key, on the branch that carries the source rows.
- SCD2 emits closed and new versions from one pass over the join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from lakeforge.functions import open_end
from lakeforge.operators.clean import latest_per_key

# The SCD2 metadata columns, named as the snapshot tool of the
# source project names them (the versioned view and current-fact filter
# read the last two).
SCD2_META = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")
SPREAD = "_spread"
#: The column of a change image that says what it is; NULL in a row that is no image.
CHANGE = "_change_type"
#: Equal rows that come out of one input row at a time.
REPEATS = 65_536


def _any_null(keys: Sequence[str], prefix: str = "") -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(f"{prefix}{k}").isNull()
    return cond


def _has(dtype: DataType, *kinds) -> bool:
    """Whether a type is one of ``kinds`` or holds one."""
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, ArrayType):
        return _has(dtype.elementType, *kinds)
    if isinstance(dtype, MapType):
        return _has(dtype.keyType, *kinds) or _has(dtype.valueType, *kinds)
    return isinstance(dtype, StructType) and any(_has(f.dataType, *kinds) for f in dtype.fields)


def comparable(df: DataFrame, name: str, prefix: str = "") -> Column:
    """A column in a form that Spark can compare and group: maps and variants have none of
    their own, so their JSON text stands for them (a map's with its keys in order)."""
    dtype, c = df.schema[name].dataType, F.col(f"{prefix}{name}")
    if isinstance(dtype, MapType) and not _has(dtype.keyType, MapType, VariantType):
        keys = F.array_sort(F.map_keys(c))
        c = F.when(c.isNotNull(), F.struct(keys.alias("k"), F.transform(keys, lambda k: c[k]).alias("v")))
        return F.to_json(c) if _has(dtype.valueType, MapType, VariantType) else c
    return F.to_json(F.struct(c.alias("v"))) if _has(dtype, MapType, VariantType) else c


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the join column that spreads rows whose key has a NULL part."""
    plain = [f.name for f in df.schema.fields if not _has(f.dataType, MapType, VariantType)]
    return df.withColumn(SPREAD, F.when(_any_null(keys), F.xxhash64(*plain)).otherwise(F.lit(0)))


def unique_source(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per complete key; rows whose key has a NULL part all stay.

    ``on_duplicate``: ``error`` fails the job when a key repeats (the
    source system rejects such a merge, trap T16); ``latest`` keeps the
    row with the greatest ``order_by``, which must be given; ``keep``
    trusts the caller.
    """
    return _unique(source, keys, on_duplicate, order_by).drop(SPREAD)


def _unique(source: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str] | None) -> DataFrame:
    """``unique_source`` with the spreading column: a join on the keys and that column then takes the rows where they are."""
    spread = source if SPREAD in source.columns else _spread(source, keys)
    if on_duplicate == "keep":
        return spread
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        return latest_per_key(spread, [*keys, SPREAD], order_by)
    if on_duplicate != "error":
        raise ValueError(on_duplicate)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, SPREAD))
    repeated = (F.col("_n") > 1) & (F.col(SPREAD) == 0)
    checked = spread.withColumn("_n", n).filter(
        F.when(repeated, F.raise_error(F.lit("duplicate source key in merge"))).otherwise(F.lit(True))
    )
    return checked.drop("_n")


def _outer(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on complete keys: ``t_*`` and ``s_*`` columns, and ``_t`` / ``_s`` where a side is present."""
    return _join(target, source, keys, "full_outer")


def _join(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """As ``_outer``; ``how`` is "full_outer", or "left" to keep the source's rows only."""
    t, s = (df if SPREAD in df.columns else _spread(df, keys) for df in (target, source))
    t = t.select(*[F.col(c).alias(f"t_{c}") for c in t.columns], F.lit(True).alias("_t"))
    s = s.select(*[F.col(c).alias(f"s_{c}") for c in s.columns], F.lit(True).alias("_s"))
    same = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in [*keys, SPREAD]]
    return s.join(t, same, "left") if how == "left" else t.join(s, same, how)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """M1/M4: matched keys take the source row, new keys are inserted.

    Never deletes. Target-only columns of updated rows keep their value;
    source-only columns appear as new columns (NULL for untouched rows).
    NULL-key source rows are always inserted; NULL-key target rows stay.
    """
    if set(source.columns) == set(target.columns):
        complete = source.filter(~_any_null(keys)).select(*keys, F.lit(0).cast("bigint").alias(SPREAD))
        kept = _spread(target, keys).join(complete, [*keys, SPREAD], "left_anti").drop(SPREAD)
        return kept.select(*target.columns).unionByName(unique_source(source, keys, on_duplicate, order_by))
    checked = _unique(source, keys, on_duplicate, order_by)
    return _outer(target, checked, keys).select(*_merged(target, source))


def _merged(target: DataFrame, source: DataFrame) -> list[Column]:
    """The row that an upsert leaves, from the joined ``t_*`` and ``s_*`` columns."""
    hit, columns = F.col("_s").isNotNull(), []
    for c in [*target.columns, *(c for c in source.columns if c not in target.columns)]:
        if c not in source.columns:
            columns.append(F.col(f"t_{c}").alias(c))
        elif c not in target.columns:
            columns.append(F.col(f"s_{c}").alias(c))
        else:
            columns.append(F.when(hit, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
    return columns


def _image(columns: Sequence[Column], kind: str | None) -> Column:
    return F.struct(*columns, F.lit(kind).cast("string").alias(CHANGE))


def _images(target: DataFrame, source: DataFrame) -> Column:
    """The change images of one joined row of an upsert, as an array: none if it changes nothing."""
    new = _merged(target, source)
    before = [F.col(f"t_{c}") if c in target.columns else F.lit(None) for c in _names(target, source)]
    old = [b.cast(source.schema[c].dataType if c not in target.columns else target.schema[c].dataType).alias(c) for b, c in zip(before, _names(target, source))]
    shared = [c for c in source.columns if c in target.columns]
    differs = F.lit(False)
    for c in shared:
        differs = differs | ~comparable(target, c, "t_").eqNullSafe(comparable(source, c, "s_"))
    for c in source.columns:  # a column that the target lacks changes where it brings a value
        if c not in shared:
            differs = differs | F.col(f"s_{c}").isNotNull()
    has_t, has_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    return (
        F.when(has_s & ~has_t, F.array(_image(new, "insert")))
        .when(has_s & has_t & differs, F.array(_image(old, "update_preimage"), _image(new, "update_postimage")))
        .otherwise(F.array())
    )


def _names(target: DataFrame, source: DataFrame) -> list[str]:
    return [*target.columns, *(c for c in source.columns if c not in target.columns)]


def upsert_images(target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                  order_by: Sequence[str] | None = None) -> DataFrame:
    """The change images of ``upsert(target, source, keys)``, without building its result.

    Only keys of the batch can change, so the batch is left-joined to the
    target: neither version is read as a whole for comparison. The images
    are those of ``change_feed``.
    """
    joined = _join(target, _unique(source, keys, on_duplicate, order_by), keys, "left")
    return joined.select(F.explode(_images(target, source)).alias("_c")).select("_c.*")


def upsert_with_images(target: DataFrame | None, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
                       order_by: Sequence[str] | None = None) -> DataFrame:
    """M1 + M12 from one join: the merged rows (``_change_type`` NULL) and the change images beside them.

    Without a target every source row is a row and an insert.
    """
    checked = _unique(source, keys, on_duplicate, order_by)
    if target is None:
        own = [F.col(c) for c in source.columns]
        pair = F.array(_image(own, None), _image(own, "insert"))
        return checked.select(F.explode(pair).alias("_c")).select("_c.*")
    row = F.array(_image(_merged(target, source), None))
    rows = F.concat(row, _images(target, source))
    return _outer(target, checked, keys).select(F.explode(rows).alias("_c")).select("_c.*")


def insert_absent(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target does not hold, one per key; NULL parts are equal to each other.

    Of source rows with one key, any one stays (they are copies of each other
    where the key is the whole row or its identity).
    """
    fresh = source.dropDuplicates(list(keys))
    if target is None:
        return fresh
    seen = target.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    return fresh.join(seen, [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys], "left_anti")


def scd1_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    now,
    insert_col: str = "insert_dts",
    update_col: str = "update_dts",
    on_duplicate: str = "error",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """M2: SCD type 1 on a (composite) key.

    Matched: every non-key column and ``update_col`` take the source values,
    ``insert_col`` keeps the target's. Not matched: inserted with both
    times = ``now``. Source rows need not carry the two time columns.
    """
    now_c = now if isinstance(now, Column) else F.lit(now).cast(target.schema[update_col].dataType)
    source = _unique(source.drop(insert_col, update_col), keys, on_duplicate, order_by)
    hit = F.col("_s").isNotNull()
    columns = []
    for c in target.columns:
        old = F.col(f"t_{c}")
        if c == insert_col:
            new = F.when(F.col("_t").isNull(), now_c).otherwise(old)
        elif c == update_col:
            new = F.when(hit, now_c).otherwise(old)
        else:
            new = F.when(hit, F.col(f"s_{c}")).otherwise(old) if c in source.columns else old
        columns.append(new.alias(c))
    return _outer(target, source, keys).select(*columns)


def cdc_scd1(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """M3: sequenced SCD1 (automatic CDC flow semantics, no deletes).

    The newest ``sequence_by`` per key in the source wins; it replaces the
    target row only if it is not older than it, so late, older rows are
    ignored and replaying a batch changes nothing.
    """
    latest = latest_per_key(source, keys, [sequence_by], tiebreak)
    if target is None:
        return latest
    cols = target.columns  # at most one row per key, NULL parts included
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = latest.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_s"))
    j = t.join(s, [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys], "full_outer")
    take_s = F.col("_s").isNotNull() & (
        F.col("_t").isNull()
        | F.col(f"t_{sequence_by}").isNull()
        | (F.col(f"s_{sequence_by}") >= F.col(f"t_{sequence_by}"))
    )
    return j.select(
        *[F.when(take_s, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols]
    )


def folded(c: str) -> Column:
    """A text compared without regard to case, as a case-insensitive collation does."""
    return F.collate(F.col(c), "UNICODE_CI")


def _changed(cols: Sequence[str], case_insensitive: Sequence[str] = ()) -> Column:
    cond = F.lit(False)
    for c in cols:
        side = folded if c in case_insensitive else F.col
        cond = cond | ~side(f"t_{c}").eqNullSafe(side(f"s_{c}"))
    return cond


def scd_id(keys: Sequence[str], ts: Column, prefix: str = "", id_key: Callable[[str], Column] | None = None) -> Column:
    """Version id: md5 of the key and the version time joined by '|'."""
    key = id_key(prefix) if id_key else F.concat_ws("|", *[F.coalesce(F.col(f"{prefix}{k}").cast("string"), F.lit("")) for k in keys])
    return F.md5(F.concat_ws("|", key, F.coalesce(ts.cast("string"), F.lit(""))))


def scd2_open(
    open_versions: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    now,
    case_insensitive_cols: Sequence[str] = (),
    case_insensitive_keys: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[str] | None = None,
    id_key: Callable[[str], Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """M5/M6 on the open versions alone: open, newly closed and new versions.

    One join; a pair whose checked columns differ (NULL-safe) gives two
    rows, the open version closed at ``now`` and a new open one. Keys missing
    from the source stay open (no hard deletes). Keys listed as
    case-insensitive meet, and count as repeated, whatever their case.
    ``id_key`` gives the key that goes into the version id, from columns with
    a prefix; by default the key's parts joined by '|'. A stored id that is
    the one computed from its row does not travel to the join: it is computed
    again behind it.

    With ``partitions``, rows meet in so many, dealt by the key, and the
    result stays there: a table stored in buckets that follow the same
    dealing is written without another exchange.
    """
    now_c = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    columns = source.columns
    fold = {k: f"_fold_{k}" for k in case_insensitive_keys}
    match = [fold.get(k, k) for k in keys]

    def with_folds(df: DataFrame) -> DataFrame:
        df = df.withColumns({f: folded(k) for k, f in fold.items()}) if fold else df
        return _spread(df, match).repartition(partitions, *match, SPREAD) if partitions else df

    source = _unique(with_folds(source), match, on_duplicate, order_by)

    def version(prefix: str = "") -> list[Column]:
        return [
            *[F.col(f"{prefix}{c}").alias(c) for c in columns],
            scd_id(keys, now_c, prefix, id_key).alias("dbt_scd_id"),
            now_c.alias("dbt_updated_at"),
            now_c.alias("dbt_valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
        ]

    if open_versions is None:
        return source.select(*version())
    out = open_versions.columns
    derived = F.col("dbt_scd_id").eqNullSafe(scd_id(keys, F.col("dbt_valid_from"), id_key=id_key))
    kept = open_versions.withColumn("_derived", derived).withColumn("dbt_scd_id", F.when(~F.col("_derived"), F.col("dbt_scd_id")))
    joined = _outer(with_folds(kept), source, match)
    joined = joined.withColumn("t_dbt_scd_id", F.when(F.col("t__derived"), scd_id(keys, F.col("t_dbt_valid_from"), "t_", id_key)).otherwise(F.col("t_dbt_scd_id")))
    both = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    changed = both & _changed(check_cols, case_insensitive_cols)
    new = dict(zip([*columns, *SCD2_META], version("s_")))
    old = {c: F.col(f"t_{c}") for c in out} | {"dbt_valid_to": F.when(changed, now_c).otherwise(F.col("t_dbt_valid_to"))}
    old_row, new_row = (F.struct(*[row[c].alias(c) for c in out]) for row in (old, new))
    rows = F.when(changed, F.array(old_row, new_row)).when(F.col("_t").isNotNull(), F.array(old_row)).otherwise(F.array(new_row))
    return joined.select(F.explode(rows).alias("_v")).select("_v.*")


def scd2_snapshot(history: DataFrame | None, source: DataFrame, keys: Sequence[str], check_cols: Sequence[str], now, **options) -> DataFrame:
    """M5/M6: SCD2 snapshot, *check* strategy, over a whole history.

    History columns: the source columns plus ``dbt_scd_id``,
    ``dbt_updated_at``, ``dbt_valid_from``, ``dbt_valid_to`` (NULL = open).
    Closed versions pass through; the rest is ``scd2_open`` (and its options).
    """
    if history is None:
        return scd2_open(None, source, keys, check_cols, now, **options)
    closed = history.filter(F.col("dbt_valid_to").isNotNull())
    open_versions = history.filter(F.col("dbt_valid_to").isNull())
    return closed.unionByName(scd2_open(open_versions, source, keys, check_cols, now, **options))


def versioned_view(hist: DataFrame, keep: Sequence[str], high: str | None = None) -> DataFrame:
    """M7: version start / end (open end → high date) plus the kept columns."""
    end = open_end("dbt_valid_to") if high is None else open_end("dbt_valid_to", high)
    return hist.select(
        *[F.col(c) for c in keep[:1]],
        F.col("dbt_valid_from").alias("vrsn_strt_dts"),
        end.alias("vrsn_end_dts"),
        *[F.col(c) for c in keep[1:]],
    )


def change_feed(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Row-level changes between two versions of a keyed table.

    Emits ``insert``, ``delete``, ``update_preimage`` and
    ``update_postimage`` rows (the change-data-feed vocabulary) with a
    ``_change_type`` column; unchanged rows emit nothing. Complete keys are
    unique in each version. Rows whose key has a NULL part are compared as a
    multiset: as many as one version has more of come out as inserts or
    deletes. Columns may be of any type, maps and variants included.
    ``upsert_images`` gives an upsert's changes without a second version.
    """
    cols = before.columns
    compare = [c for c in (compare or cols) if c not in keys]
    has_t, has_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~comparable(before, c, "t_").eqNullSafe(comparable(after, c, "s_"))

    def image(prefix: str, kind: str) -> Column:
        return _image([F.col(f"{prefix}{c}").alias(c) for c in cols], kind)

    # No branch taken (unchanged row) → NULL array → explode emits nothing.
    images = (
        F.when(has_t & ~has_s, F.array(image("t_", "delete")))
        .when(~has_t & has_s, F.array(image("s_", "insert")))
        .when(differs, F.array(image("t_", "update_preimage"), image("s_", "update_postimage")))
    )
    complete = ~_any_null(keys)
    rows = _outer(before.filter(complete), after.filter(complete), keys).select(F.explode(images).alias("_c")).select("_c.*")
    return rows.unionByName(_net_changes(before.filter(~complete), after.filter(~complete)))


def _net_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Inserts and deletes between two multisets of rows.

    Equal rows are counted, with a partial count per task, and never meet; a
    count turns back into rows ``REPEATS`` at a time.
    """
    cols = before.columns
    both = before.withColumn("_sign", F.lit(-1)).unionByName(after.select(*cols).withColumn("_sign", F.lit(1)))
    whole = F.struct(*[F.col(c) for c in cols]).alias("_row")
    forms = [comparable(before, c).alias(f"_form{i}") for i, c in enumerate(cols)]
    net = both.select(whole, "_sign", *forms).groupBy(*[f"_form{i}" for i in range(len(cols))])
    net = net.agg(F.sum("_sign").alias("_net"), F.any_value("_row").alias("_row")).filter("_net <> 0")
    kind = F.when(F.col("_net") > 0, "insert").otherwise("delete").alias(CHANGE)
    n = F.abs("_net")
    parts = net.select("_row", kind, n.alias("_n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / REPEATS))).alias("_part"))
    size = F.least(F.col("_n") - F.col("_part") * REPEATS, F.lit(REPEATS))
    rows = parts.select("_row", CHANGE, F.explode(F.sequence(F.lit(1), size)).alias("_i"))
    return rows.select("_row.*", CHANGE)
