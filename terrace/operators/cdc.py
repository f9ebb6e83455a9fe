"""Change capture: apply a feed of row changes as a type 1 or a type 2 table.

Type 1 keeps the latest row per key. It is a plain aggregate (``max`` of a struct that
starts with the sequence), so it combines on the map side, does not care how large a
key is, and may be applied again to its own output: merging partial results in any
order, any number of times, gives the same table. The streaming form relies on that.

Type 2 keeps every version of a key with the half-open interval ``[valid_from,
valid_to)`` in which it held. It is one pass of windows per key; hot keys are cut into
slices (see ``ordered``).

Data columns must be of types Spark can order (no maps). Sequences must not be NULL, and changes
of a key that tie and differ are an error unless asked otherwise (``Cdc.ties``); equal
changes, such as a replay brings, are one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.ordered import (
    SLICE,
    fill_forward,
    find_hot_keys,
    join_carry,
    per_key,
    settle,
    split_hot_keys,
)
from terrace.session import materialize

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"

_DIGEST = "_digest"
_DELETE = "_delete"
_TRUNCATE = "_truncate"
_HIDDEN = "_seq"
_HIGH, _LOW = "_high", "_low"


def _listed(value: str | Column | Sequence[str | Column]) -> tuple[str | Column, ...]:
    return (value,) if isinstance(value, (str, Column)) else tuple(value)


def _fails(what: str, keys: Sequence[str]) -> Column:
    """An error that names the key, raised for the rows that reach it; as a condition, it has a type."""
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return F.raise_error(F.concat(F.lit(f"{what}: "), named)).cast("boolean")


def _digest(columns: Sequence[str]) -> Column:
    return F.xxhash64(F.col(_DELETE), *columns)


@dataclass(frozen=True)
class Cdc:
    """How to read a change feed.

    keys            columns that identify a row
    sequence_by     column(s) giving the order of changes, most significant first; add a
                    unique last column when the first may tie within a key
    columns         data columns to keep (default: all); keys are always kept
    except_columns  columns to leave out of the target; they may still be sequence columns
    deletes         predicate: this change deletes the key
    truncates       predicate: this change empties the whole table (type 1 only)
    ignore_nulls    a NULL in a newer change keeps the older value
    track           type 2: only changes in these columns open a new version; the other
                    columns of the open version are updated in place
    track_except    type 2: the same, given by exclusion
    hot_rows        type 2: cut keys above this many rows into slices (default: 10 million)
    ties            "error": changes of a key that tie on the sequence and differ are an error
                    when the result is computed; "values": the larger data columns win

    A NULL in a sequence column is an error when the result is computed.
    """

    keys: Sequence[str] | str
    sequence_by: str | Column | Sequence[str | Column]
    columns: Sequence[str] | None = None
    except_columns: Sequence[str] | None = None
    deletes: str | Column | None = None
    truncates: str | Column | None = None
    ignore_nulls: bool = False
    track: Sequence[str] | None = None
    track_except: Sequence[str] | None = None
    hot_rows: int | None = None
    ties: str = "error"
    key_list: tuple[str, ...] = field(init=False)
    order_list: tuple[str | Column, ...] = field(init=False)

    def __post_init__(self) -> None:
        if self.columns is not None and self.except_columns is not None:
            raise ValueError("give columns or except_columns, not both")
        if self.track is not None and self.track_except is not None:
            raise ValueError("give track or track_except, not both")
        if self.ties not in ("error", "values"):
            raise ValueError(f"ties must be 'error' or 'values', not '{self.ties}'")
        object.__setattr__(self, "key_list", _listed(self.keys))
        object.__setattr__(self, "order_list", _listed(self.sequence_by))
        if not self.key_list or not self.order_list:
            raise ValueError("keys and sequence_by must not be empty")

    # -- columns -------------------------------------------------------------

    def data_columns(self, source: DataFrame) -> list[str]:
        """Target columns other than the keys."""
        keys = set(self.key_list)
        for label, names in (
            ("keys", self.key_list),
            ("columns", self.columns),
            ("except_columns", self.except_columns),
            ("track", self.track),
            ("track_except", self.track_except),
        ):
            unknown = [n for n in names or () if n not in source.columns]
            if unknown:
                raise ValueError(f"{label}: no column {unknown} in {source.columns}")
        if keys & set(self.except_columns or ()):
            raise ValueError("except_columns must not name a key")
        if self.columns is not None:
            return [c for c in source.columns if c in self.columns and c not in keys]
        left_out = keys | set(self.except_columns or ())
        return [c for c in source.columns if c not in left_out]

    def tracked_columns(self, source: DataFrame) -> list[str]:
        data = self.data_columns(source)
        if self.track is not None:
            missing = [c for c in self.track if c not in data]
            if missing:
                raise ValueError(f"track: {missing} not in the target")
            return [c for c in data if c in self.track]
        sequence = source.select(*self.order_list).columns
        skipped = set(sequence) | set(self.track_except or ())
        return [c for c in data if c not in skipped]

    def sequence(self, source: DataFrame) -> list[str]:
        """Names of the sequence columns in ``changes``: their own where they are data columns."""
        data = self.data_columns(source)
        return [c if isinstance(c, str) and c in data else f"{_HIDDEN}{i}" for i, c in enumerate(self.order_list)]

    def _flag(self, predicate: str | Column | None) -> Column:
        if predicate is None:
            return F.lit(False)
        return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))

    def changes(self, source: DataFrame) -> DataFrame:
        """``source`` reduced to keys, internal sequence, flags and data columns."""
        hidden = {
            name: F.col(c) if isinstance(c, str) else c
            for name, c in zip(self.sequence(source), self.order_list)
            if name.startswith(_HIDDEN)
        }
        # The flag is part of every result, so the check is never left out.
        missing = reduce(lambda a, b: a | b, [(F.col(c) if isinstance(c, str) else c).isNull() for c in self.order_list])
        deletes = F.when(missing, _fails("a change has NULL in its sequence", self.key_list)).otherwise(self._flag(self.deletes))
        return source.select(
            *self.key_list,
            *[c.alias(n) for n, c in hidden.items()],
            deletes.alias(_DELETE),
            self._flag(self.truncates).alias(_TRUNCATE),
            *self.data_columns(source),
        )


# --- checks -----------------------------------------------------------------


def sequence_ties(df: DataFrame, cdc: Cdc) -> DataFrame:
    """Keys with several changes at one sequence value, and how many (``n``)."""
    changes = cdc.changes(df)
    return (
        changes.groupBy(*cdc.key_list, *cdc.sequence(df))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def require_unique_sequence(df: DataFrame, cdc: Cdc) -> DataFrame:
    """``df`` unchanged, or an error if changes of one key tie, also equal ones and those of old versions."""
    example = sequence_ties(df, cdc).first()
    if example is not None:
        raise ValueError(f"changes tie on key and sequence, add a tiebreak column: {example.asDict()}")
    return df


# --- type 1 -----------------------------------------------------------------


def _says(name: str, *position: str) -> Column:
    """For null-ignoring updates: what a change says about one column, or NULL for nothing.

    A delete says "forget the value", so that a later insert starts afresh.
    """
    value = F.when(~F.col(_DELETE), F.col(name)).alias("value")
    return F.when(F.col(_DELETE) | F.col(name).isNotNull(), F.struct(*position, value))


def _state_keys(cdc: Cdc) -> list[str]:
    """Keys alone where possible: the state is then partitioned for joins on the key."""
    return [*cdc.key_list, *([_TRUNCATE] if cdc.truncates is not None else [])]


def scd1_state(df: DataFrame, cdc: Cdc) -> DataFrame:
    """Mergeable type 1 state: one row per key, deletes kept as tombstones.

    Also holds one row with ``_truncate`` set when the feed has a truncate.
    """
    data = cdc.data_columns(df)
    sequence = cdc.sequence(df)
    changes = cdc.changes(df)
    if cdc.truncates is not None:
        # A truncate concerns the table, not the key of the row that carries it.
        changes = changes.withColumns({k: F.when(~F.col(_TRUNCATE), F.col(k)) for k in cdc.key_list})
    if cdc.ignore_nulls:
        measures = [F.max(F.struct(*sequence, _DELETE)).alias("_row")]
        measures += [F.max(_says(c, *sequence, _DELETE)).alias(f"_last_{c}") for c in data]
    else:
        values = [c for c in data if c not in sequence]
        measures = [F.max(F.struct(*sequence, _DELETE, *values)).alias("_row")]
    if cdc.ties == "error":
        # Least and greatest digest at the highest sequence: they differ where changes tie.
        digest = _digest([c for c in data if c not in sequence])
        measures += [F.max(F.struct(*sequence, digest.alias("d"))).alias(_HIGH)]
        measures += [F.max(F.struct(*sequence, F.bitwise_not(digest).alias("d"))).alias(_LOW)]
    return changes.groupBy(*_state_keys(cdc)).agg(*measures)


def scd1_merge(state: DataFrame, cdc: Cdc) -> DataFrame:
    """Merge a union of type 1 states into one."""
    by = _state_keys(cdc)
    return state.groupBy(*by).agg(*[F.max(c).alias(c) for c in state.columns if c not in by])


def scd1_rows(state: DataFrame, cdc: Cdc) -> DataFrame:
    """The current rows of a merged state."""
    fields = state.schema["_row"].dataType.names
    sequence = fields[: fields.index(_DELETE)]

    def position(struct: str) -> Column:
        return F.struct(*[F.col(f"{struct}.`{s}`") for s in sequence])

    def after_cut(struct: str) -> Column:
        return F.lit(True)

    if cdc.truncates is not None:
        cut = state.filter(_TRUNCATE).agg(F.max(position("_row"))).scalar()
        state = state.filter(~F.col(_TRUNCATE)).withColumn("_cut", cut)

        def after_cut(struct: str) -> Column:
            return F.col("_cut").isNull() | (position(struct) > F.col("_cut"))

        state = state.filter(after_cut("_row"))

    gone = F.col(f"_row.{_DELETE}")
    if _HIGH in state.columns and cdc.ties == "error":
        tie = F.col(f"{_HIGH}.d") != F.bitwise_not(f"{_LOW}.d")
        gone = F.when(tie, _fails("changes tie on key and sequence, add a tiebreak column", cdc.key_list)).otherwise(gone)
    alive = state.filter(~gone)
    if cdc.ignore_nulls:
        names = [c.removeprefix("_last_") for c in state.columns if c.startswith("_last_")]
        values = [F.when(after_cut(f"_last_{c}"), F.col(f"`_last_{c}`.value")).alias(c) for c in names]
    else:
        values = [
            F.col(f"_row.`{c}`").alias(c) for c in fields if c != _DELETE and not c.startswith(_HIDDEN)
        ]
    return alive.select(*cdc.key_list, *values)


def scd1(df: DataFrame, cdc: Cdc) -> DataFrame:
    """Current rows of a change feed: the latest per key, deleted keys left out."""
    return scd1_rows(scd1_state(df, cdc), cdc).select(*cdc.key_list, *cdc.data_columns(df))


# --- type 2 -----------------------------------------------------------------


def scd2(df: DataFrame, cdc: Cdc, opened_by: str | None = None) -> DataFrame:
    """Versions of a change feed with ``valid_from``, ``valid_to`` (NULL: open) and ``is_current``.

    Changes equal on the tracked columns to the one before them join its version. A
    delete closes the open version. ``valid_from`` and ``valid_to`` are values of the
    first sequence column. ``opened_by`` names a further column for the whole sequence of the
    change that opened a version, as a struct.
    """
    if cdc.truncates is not None:
        raise ValueError("truncates is for type 1 only: a history keeps what was truncated")
    keys = list(cdc.key_list)
    data = cdc.data_columns(df)
    tracked = cdc.tracked_columns(df)
    changes = cdc.changes(df).drop(_TRUNCATE)
    # Rows that tie on the sequence are put in order by their own values, so that a
    # recomputed task gives the same answer.
    sequence = cdc.sequence(df)
    order = [*sequence, _DELETE, *[c for c in data if c not in sequence]]
    opening = F.struct(*[F.col(c).alias(f"s{k}") for k, c in enumerate(sequence)]) if opened_by else F.col(order[0])

    hot = find_hot_keys(changes, keys, cdc.hot_rows)
    changes = settle(changes, hot)
    if cdc.ignore_nulls:
        nullable = [c for c in data if c not in sequence]
        changes = (
            fill_forward(changes, keys, order, {f"_last_{c}": _says(c) for c in nullable}, hot)
            .withColumns({c: F.col(f"`_last_{c}`.value") for c in nullable})
            .drop(*[f"_last_{c}" for c in nullable])
        )

    checked = sequence if cdc.ties == "error" else None
    if checked:
        changes = changes.withColumn(_DIGEST, _digest([c for c in data if c not in sequence]))
    split = split_hot_keys(changes, order, hot)
    versions = _versions(_local_changes(split.cold, keys, order, tracked, checked), keys, order, opening)
    if split.hot is not None:
        if checked:
            _require_no_ties(split.hot, [*keys, *sequence])
        sliced = _local_changes(split.hot, [*keys, SLICE], order, tracked)
        carry = materialize(_slice_carry(sliced, keys, order, tracked, opening), "carry")
        of_hot = _versions(join_carry(sliced, carry, keys), [*keys, SLICE], order, opening, carried=True)
        versions = versions.unionByName(of_hot.select(*versions.columns))
    versions = versions.filter(~F.col(_DELETE))
    if opened_by:
        versions = versions.withColumns({opened_by: F.col(VALID_FROM), VALID_FROM: F.col(f"{VALID_FROM}.s0")})
    return versions.select(
        *keys,
        *data,
        VALID_FROM,
        VALID_TO,
        F.col(VALID_TO).isNull().alias(IS_CURRENT),
        *([opened_by] if opened_by else []),
    )


def _require_no_ties(rows: DataFrame, by: Sequence[str]) -> None:
    """An error if changes tie, for keys cut into slices: a tie may lie on both sides of a cut."""
    same = rows.groupBy(*by).agg((F.min(_DIGEST) != F.max(_DIGEST)).alias("tie")).filter("tie").drop("tie").first()
    if same is not None:
        raise ValueError(f"changes tie on key and sequence, add a tiebreak column: {same.asDict()}")


def _local_changes(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], tracked: Sequence[str], checked: Sequence[str] | None = None
) -> DataFrame:
    """Compare each row with its neighbours in one pass.

    Rows that are equal in the columns ``checked`` to the one before them and differ from it
    in their digest are an error.

    ``_opens``  differs from the row before it (NULL on the first row of a window)
    ``_closes``  differs from the row after it (NULL on the last row), at ``_closed_at``
    """
    window = per_key(by, order)

    def differs(prefix: str) -> Column:
        deleted = F.col(prefix + _DELETE)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in tracked], F.lit(True))
        return F.when(deleted.isNotNull(), ~((deleted == F.col(_DELETE)) & (F.col(_DELETE) | same)))

    before = {f"_before_{c}": F.lag(c).over(window) for c in (_DELETE, *tracked)}
    opens = differs("_before_")
    if checked:
        before |= {"_before_at": F.lag(F.struct(*checked)).over(window), f"_before_{_DIGEST}": F.lag(_DIGEST).over(window)}
        tie = (F.col("_before_at") == F.struct(*checked)) & (F.col(f"_before_{_DIGEST}") != F.col(_DIGEST))
        opens = F.when(tie, _fails("changes tie on key and sequence, add a tiebreak column", by)).otherwise(opens)
    after = {f"_after_{c}": F.lead(c).over(window) for c in (_DELETE, *tracked)}
    return (
        rows.withColumns({**before, **after, "_closed_at": F.lead(order[0]).over(window)})
        .withColumns({"_opens": opens, "_closes": differs("_after_")})
        .drop(*before, *after, _DIGEST)
    )


def _slice_carry(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str], opening: Column
) -> DataFrame:
    """What each slice of a hot key needs from the slices around it; one row per slice."""
    seen = F.struct(_DELETE, *[F.when(~F.col(_DELETE), F.col(c)).alias(c) for c in tracked])
    first, last = F.col("_opens").isNull(), F.col("_closes").isNull()
    edges = rows.groupBy(*keys, SLICE).agg(
        F.max(F.when(first, seen)).alias("_first_seen"),
        F.max(F.when(first, F.col(order[0]))).alias("_first_at"),
        F.max(F.when(first, opening)).alias("_first_opening"),
        F.max(F.when(last, seen)).alias("_last_seen"),
        F.max(F.when(F.col("_opens"), opening)).alias("_last_inner_start"),
    )
    along = per_key(keys, [SLICE])
    edges = edges.withColumn(
        "_in_opens", ~F.lag("_last_seen").over(along).eqNullSafe(F.col("_first_seen"))
    ).withColumn("_last_start", F.coalesce("_last_inner_start", F.when(F.col("_in_opens"), F.col("_first_opening"))))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        *keys,
        SLICE,
        "_in_opens",
        F.last("_last_start", ignorenulls=True).over(earlier).alias("_in_start"),
        F.lead("_in_opens").over(along).alias("_next_opens"),
        F.lead("_first_at").over(along).alias("_next_at"),
    )


def _versions(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], opening: Column, *, carried: bool = False
) -> DataFrame:
    """Keep the last row of each version and give it its interval, which starts with ``opening`` of its first row.

    Only rows that open or close a version matter. The row that closes one is the row
    that opened it, or comes right after that row among those kept.
    """
    opens, closes, closed_at, before = F.lit(True), F.lit(True), F.lit(None), F.lag(opening).over(per_key(by, order))
    if carried:
        opens, closes, closed_at = F.col("_in_opens"), F.coalesce("_next_opens", F.lit(True)), F.col("_next_at")
        before = F.coalesce(before, F.col("_in_start"))
    edges = rows.withColumns(
        {
            "_opens": F.coalesce("_opens", opens),
            "_closed_at": F.when(F.col("_closes").isNotNull(), F.col("_closed_at")).otherwise(closed_at),
            "_closes": F.coalesce("_closes", closes),
        }
    ).filter("_opens OR _closes")
    return (
        edges.withColumn("_opened_at", before)
        .filter("_closes")
        .withColumns(
            {
                VALID_FROM: F.when(F.col("_opens"), opening).otherwise(F.col("_opened_at")),
                VALID_TO: F.col("_closed_at"),
            }
        )
    )
