"""Joins beyond the plain one: lookups, alternate keys, identities, cascades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.clean import id_or_name


def lookup(df: DataFrame, ref: DataFrame, on: str, key: str, cols: dict[str, str], how: str = "left") -> DataFrame:
    """Columns of a reference table under new names; Spark broadcasts the table if its size is known to be small."""
    slim = ref.select(F.col(key).alias("_key"), *[F.col(c).alias(new) for c, new in cols.items()])
    return df.join(slim, df[on] == F.col("_key"), how).drop("_key")


def exploded_keys(dim: DataFrame, keys: Sequence[str], out: str = "alt_key") -> DataFrame:
    """A dimension's rows once under each of its keys (as normalised text); null keys are left out, equal ones count once."""
    each = F.explode(F.array_distinct(F.array_compact(F.array(*[id_or_name(F.col(k).cast("string")) for k in keys]))))
    return dim.withColumn(out, each)


def alt_key_join(df: DataFrame, dim: DataFrame, ref: str, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by a reference that holds either of several keys."""
    d = exploded_keys(dim, keys, "_alt")
    return df.join(d, id_or_name(F.col(ref)) == d["_alt"], how).drop("_alt")


def identity_condition(a: DataFrame, b: DataFrame, cols: Sequence[str], nullable: Sequence[str] = ()) -> Column:
    """Equal without regard to case; ``nullable`` columns take null and '' for equal."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.upper(a[c]) == F.upper(b[c]))
    for c in nullable:
        cond = cond & (F.upper(F.coalesce(a[c], F.lit(""))) == F.upper(F.coalesce(b[c], F.lit(""))))
    return cond


def identity_match(a: DataFrame, b: DataFrame, cols: Sequence[str], nullable: Sequence[str] = (), flag: str = "matched") -> DataFrame:
    """Rows of ``a`` with whether ``b`` has the same identity; never more rows than ``a`` has."""
    fold = lambda d, c: F.upper(F.coalesce(d[c], F.lit("")) if c in nullable else d[c])
    names = [*cols, *nullable]
    known = b.select(*[fold(b, c).alias(f"_{c}") for c in names]).distinct().withColumn("_known", F.lit(True))
    on = [fold(a, c) == known[f"_{c}"] for c in names]
    return a.join(known, on, "left").withColumn(flag, F.coalesce("_known", F.lit(False))).drop("_known", *[f"_{c}" for c in names])


def merge_updates(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two feeds of one key as one row: ``a``'s values where it has them, else ``b``'s."""
    names = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c != key]
    left, right = a.withColumnsRenamed({c: f"a_{c}" for c in a.columns}), b.withColumnsRenamed({c: f"b_{c}" for c in b.columns})
    both = left.join(right, left[f"a_{key}"] == right[f"b_{key}"], "full_outer")
    pick = lambda c: F.coalesce(*[both[f"{s}_{c}"] for s, d in (("a", a), ("b", b)) if c in d.columns])
    return both.select(pick(key).alias(key), *[pick(c).alias(c) for c in names])


def cascade(parent_changes: DataFrame, child: DataFrame, parent_key: str, at: str, carry: Sequence[str] = ()) -> DataFrame:
    """Change rows for the current children of changed parents: the child's values, the parent's moment and carried columns."""
    moved = parent_changes.select(F.col(parent_key).alias("_parent"), F.col(at).alias("_at"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    rows = child.join(moved, child[parent_key] == moved["_parent"])
    keep = [c for c in child.columns if c not in {at, *carry}]
    return rows.select(*keep, F.col("_at").alias(at), *[F.col(f"_c_{c}").alias(c) for c in carry])


def keep_known(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(ref.select(*on), [*on], "left_semi")


def drop_known(df: DataFrame, ref: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(ref.select(*on), [*on], "left_anti")


def within_lifetime(df: DataFrame, start: str, end: str, step: str = "interval 3 months", out: str = "period") -> DataFrame:
    """Each row once per period of its own lifetime (a sequence, not a cross product)."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start), F.col(end), F.expr(step))))


def from_dictionary(key: Column, values: Sequence[str], salt: int = 0) -> Column:
    """A value picked by a hash of the key."""
    return F.array(*[F.lit(v) for v in values])[F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(len(values))).cast("int")]


def affine_index(i: Column, m: int, b: int, c: int) -> Column:
    """(b i + c) mod m, a bijection of 0 … m - 1 if b and m have no common factor; bounded so that it can't overflow."""
    from math import gcd

    if gcd(b, m) != 1:
        raise ValueError(f"{b} and {m} have a common factor")
    if m > 3_000_000_000:
        raise ValueError("b * i could exceed 64 bits")
    return F.pmod(F.lit(b % m) * i + F.lit(c % m), F.lit(m))
