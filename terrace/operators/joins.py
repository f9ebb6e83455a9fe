"""Joins between facts and (versioned) dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.cdc import IS_CURRENT, VALID_FROM, VALID_TO
from terrace.operators.ordered import SLICE, HotKeys, fill_forward, find_hot_keys, per_key, settle, split_hot_keys
from terrace.session import materialize

INTERVAL = (VALID_FROM, VALID_TO, IS_CURRENT)
# Versions per key up to which a fact is compared with all of them.
DEFAULT_MAX_VERSIONS = 32
LEFT = "left"
INNER = "inner"


def inner_using(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join with one key column, widened to BIGINT on both sides first.

    Without the cast the output keeps the type of the left key, whichever is narrower.
    """
    def widen(df: DataFrame) -> DataFrame:
        return df.withColumn(key, F.col(key).cast("bigint"))

    return widen(left).join(widen(right), key, "inner")


def attributes(dim: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns of a versioned dimension other than its keys and interval."""
    return [c for c in dim.columns if c not in keys and c not in INTERVAL]


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(VALID_TO).isNull())


def with_surrogate_key(
    dim: DataFrame, keys: Sequence[str], name: str = "surrogate_key", further: Sequence[str] = ()
) -> DataFrame:
    """A stable key per version: digest of the business key, ``valid_from`` and ``further``.

    ``further`` are the other sequence columns, where versions may share ``valid_from``. It
    needs no sequence generator, so recomputing any partition gives the same keys, and
    depends on the values alone, to the microsecond, not on the session's time zone.
    """
    return dim.withColumn(name, _digest_of([_exact_text(dim, c) for c in [*keys, VALID_FROM, *further]]))


def _digest_of(parts: list[Column]) -> Column:
    # Lengths keep neighbouring values apart, and NULL apart from empty text.
    framed = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~")) for p in parts]
    return F.sha2(F.concat(*framed), 256)


def _exact_text(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"{column} is no plain value and can't be part of a surrogate key")
    return value.cast("string")


def _holds() -> Column:
    """Versions with an empty interval never hold."""
    return F.col(VALID_FROM).isNotNull() & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(VALID_FROM)))


def overlapping_versions(
    dim: DataFrame, keys: Sequence[str], hot_rows: int | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """Versions that still hold when the next one of their key begins. ``hot`` is what a count of them found, if known."""
    versions = dim.filter(_holds()).select(*keys, VALID_FROM, VALID_TO)
    hot = hot or find_hot_keys(versions, keys, hot_rows)
    split = split_hot_keys(settle(versions, hot), [VALID_FROM, VALID_TO], hot)

    def late(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        after = F.lead(VALID_FROM).over(Window.partitionBy(*by).orderBy(VALID_FROM, VALID_TO))
        found = rows.withColumn("next_from", after).filter("next_from IS NOT NULL")
        return found.filter(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col("next_from"))).select(
            *keys, VALID_FROM, VALID_TO, "next_from"
        )

    found = late(split.cold, keys)
    if split.hot is None:
        return found
    last = F.max(F.struct(VALID_FROM, F.col(VALID_TO).isNull().alias("open"), VALID_TO))
    edges = split.hot.groupBy(*keys, SLICE).agg(F.min(VALID_FROM).alias("first"), last.alias("last"))
    edges = edges.withColumn("next_from", F.lead("first").over(per_key(keys, [SLICE]))).filter(
        (F.col("last.open") & F.col("next_from").isNotNull()) | (F.col(f"last.{VALID_TO}") > F.col("next_from"))
    )
    between = edges.select(
        *keys, F.col(f"last.{VALID_FROM}").alias(VALID_FROM), F.col(f"last.{VALID_TO}").alias(VALID_TO), "next_from"
    )
    return found.unionByName(late(split.hot, [*keys, SLICE])).unionByName(between)


def require_no_overlap(
    dim: DataFrame, keys: Sequence[str], hot_rows: int | None = None, hot: HotKeys | None = None
) -> DataFrame:
    """``dim`` unchanged, or an error if versions of a key overlap."""
    example = overlapping_versions(dim, keys, hot_rows, hot).first()
    if example is not None:
        raise ValueError(f"versions of a key overlap: {example.asDict()}")
    return dim


def effective_date_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] | str,
    at: str,
    *,
    method: str = "auto",
    how: str = INNER,
    max_versions: int = DEFAULT_MAX_VERSIONS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Each fact row with the attributes of the dimension version valid at its time ``at``.

    Facts without a valid version are left out, or kept with NULL attributes if ``how`` is
    ``left``. Versions of a key that overlap are an error, as those of a type 2 table never do;
    all ways then agree on every input, and the choice between them is one of speed alone.

    ``range``    equi join with the interval as residual condition: compares every fact with
                 every version of its key; a small dimension is broadcast and the facts then
                 do not move
    ``descend``  for keys with many versions: versions in order are cut into groups of
                 ``max_versions``, the groups' starts again, and so on; a fact finds its group
                 from the top down, by one ``range`` join per level. Facts are read once, and
                 each join is one Spark can split where a key is hot
    ``sweep``    both sides are put in time order per key and the version is carried
                 forward: linear in facts plus versions, at the price of storing both
    ``auto``     takes ``range`` if no key has more than ``max_versions`` versions, else
                 ``descend``

    The dimension is stored, so that it is computed once and Spark knows its true size.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in (INNER, LEFT):
        raise ValueError(f"how must be '{INNER}' or '{LEFT}', not '{how}'")
    dim = materialize(dim, "dimension")
    hot = find_hot_keys(dim.filter(_holds()).select(*keys), keys, hot_rows)
    require_no_overlap(dim, keys, hot_rows, hot)
    if method == "auto":
        method = "range" if hot.most <= max_versions else "descend"
    if method == "range":
        return _range_join(fact, dim, keys, at, how)
    if method == "descend":
        return _descend_join(fact, dim, keys, at, how, hot.most, max_versions)
    if method == "sweep":
        return _sweep_join(fact, dim, keys, at, how, hot_rows)
    raise ValueError(f"method must be 'auto', 'sweep', 'range' or 'descend', not '{method}'")


def _present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _sweep_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], at: str, how: str, hot_rows: int | None
) -> DataFrame:
    rows = fact if how == LEFT else fact.filter(_present([*keys, at]))
    facts = rows.select(
        *keys,
        F.col(at).alias("_at"),
        F.lit(1).alias("_kind"),
        # Facts of one instant are interchangeable; the hash lets a slice end among them.
        F.xxhash64(*fact.columns).alias("_mix"),
        F.struct(*[c for c in fact.columns if c not in keys]).alias("_fact"),
    )
    names = attributes(dim, keys)
    versions = dim.filter(_present(keys) & _holds()).select(
        *keys,
        F.col(VALID_FROM).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("bigint").alias("_mix"),
        F.struct(VALID_TO, *names).alias("_version"),
    )
    # Stored once: the search for hot keys and the sweep read it from there.
    both = materialize(facts.unionByName(versions, allowMissingColumns=True), "timeline")
    timeline = fill_forward(both, keys, ["_at", "_kind", "_mix"], {"_valid": F.col("_version")}, hot_rows)
    until = F.col(f"_valid.{VALID_TO}")
    holds = F.col("_valid").isNotNull() & (until.isNull() | (F.col("_at") < until))
    timeline = timeline.filter(F.col("_kind") == 1)
    if how == INNER:
        timeline = timeline.filter(holds)
    return timeline.select(
        *[F.col(c) if c in keys else F.col(f"_fact.`{c}`").alias(c) for c in fact.columns],
        *[F.when(holds, F.col(f"_valid.`{c}`")).alias(c) for c in names],
    )


def _range_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], at: str, how: str, inside: Sequence[str] = ()
) -> DataFrame:
    """``inside`` are further columns that must be equal, and are then left out."""
    names = [c for c in attributes(dim, keys) if c not in inside]
    equals = [*keys, *inside]
    right = dim.select(*[F.col(k).alias(f"_d_{k}") for k in equals], VALID_FROM, VALID_TO, *names)
    equal = [fact[k] == right[f"_d_{k}"] for k in equals]
    valid = (fact[at] >= right[VALID_FROM]) & (right[VALID_TO].isNull() | (fact[at] < right[VALID_TO]))
    joined = fact.join(right, reduce(lambda a, b: a & b, [*equal, valid]), how)
    return joined.select(*[c for c in fact.columns if c not in inside], *names)


def _descend_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], at: str, how: str, most: int, fan: int
) -> DataFrame:
    """Versions by rank in groups of ``fan``, level by level, until a key has no more than ``fan`` groups."""
    if fan < 2:
        raise ValueError("descend needs groups of two versions at least")
    rank = F.row_number().over(per_key(keys, [VALID_FROM])) - 1
    rows = dim.filter(_present(keys) & _holds()).withColumn("_rank", rank)
    versions = materialize(rows.withColumn("_group0", F.floor(F.col("_rank") / fan)).drop("_rank"), "versions")
    levels, below = [], versions.select(*keys, F.col("_group0").alias("_here"), VALID_FROM)
    while most > fan:
        most = -(-most // fan)
        number = len(levels)
        starts = below.groupBy(*keys, "_here").agg(F.min(VALID_FROM).alias(VALID_FROM))
        starts = starts.withColumn(VALID_TO, F.lead(VALID_FROM).over(per_key(keys, ["_here"])))
        above = F.floor(F.col("_here") / fan)
        level = materialize(
            starts.select(*keys, VALID_FROM, VALID_TO, F.col("_here").alias(f"_group{number}"), above.alias(f"_group{number + 1}")),
            "version-groups",
        )
        levels.append(level)
        below = level.select(*keys, F.col(f"_group{number + 1}").alias("_here"), VALID_FROM)
    found = fact
    for number in reversed(range(len(levels))):
        top = number == len(levels) - 1
        level = levels[number].drop(f"_group{number + 1}") if top else levels[number]
        found = _range_join(found, level, keys, at, how, () if top else [f"_group{number + 1}"])
    inside = ["_group0"] if levels else []
    return _range_join(found, versions if levels else versions.drop("_group0"), keys, at, how, inside)


def with_dimension_key(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str] | str,
    at: str,
    name: str = "surrogate_key",
    *,
    inferred: str = "is_inferred",
    further: Sequence[str] = (),
    method: str = "auto",
) -> DataFrame:
    """Each fact with the surrogate key of the dimension version valid at its time.

    A fact without one, be its key unknown or its time before the first version or after a
    delete, gets the key of its inferred member (see ``inferred_members``) and is marked in
    the column ``inferred``. A fact without a business key gets NULL.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    keyed = with_surrogate_key(dim, keys, "_key", further).select(*keys, VALID_FROM, VALID_TO, "_key")
    found = effective_date_join(fact, keyed, keys, at, method=method, how=LEFT)
    # The key an inferred member has: its version has no start.
    stand_in = _digest_of([*[_exact_text(found, k) for k in keys], F.lit(None).cast("string")])
    return found.select(
        *fact.columns,
        F.when(_present(keys), F.coalesce(F.col("_key"), stand_in)).alias(name),
        (F.col("_key").isNull() & _present(keys)).alias(inferred),
    )


def inferred_members(
    facts: DataFrame, dim: DataFrame, keys: Sequence[str] | str, name: str = "surrogate_key", inferred: str = "is_inferred"
) -> DataFrame:
    """Rows for the members that facts with ``inferred`` point to: keys and surrogate key, all else NULL.

    In the columns of ``dim`` and ``name``, to be added to the dimension.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = facts.filter(F.col(inferred)).select(*keys, name).distinct()
    others = [c for c in dim.columns if c not in (*keys, name)]
    return rows.select(
        *keys, *[F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in others], name
    ).select(*[c for c in dim.columns if c != name], name)
