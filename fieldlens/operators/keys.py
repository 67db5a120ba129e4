"""Key-resolution operators: keep-first-per-key, latest revision, revision joins
(AG-18, WN-1, WN-2, BO-1, JN-2, JN-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import col


def order_spec(order: Sequence) -> list[Column]:
    """Turn ``["a", ("b", "desc"), ("c", "asc_nulls_last")]`` into explicit-NULL sort columns.

    Defaults are written out because Spark and PostgreSQL order NULLs differently:
    ascending keys sort NULLs last, descending keys NULLs first (the PostgreSQL default)
    unless a direction with an explicit NULL placement is given.
    """
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
            continue
        name, direction = (o, "asc") if isinstance(o, str) else o
        c = col(name)
        out.append({
            "asc": c.asc_nulls_last(), "desc": c.desc_nulls_first(),
            "asc_nulls_last": c.asc_nulls_last(), "asc_nulls_first": c.asc_nulls_first(),
            "desc_nulls_last": c.desc_nulls_last(), "desc_nulls_first": c.desc_nulls_first(),
        }[direction])
    return out


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """PostgreSQL ``DISTINCT ON (keys) ... ORDER BY keys, order``: first row per key.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the shuffle, so
    a hot key is cut to one row per map task before it is exchanged (map-side top-1)."""
    w = Window.partitionBy(*keys).orderBy(*order_spec(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_by(df: DataFrame, keys: Sequence[str], by: str | Sequence) -> DataFrame:
    """Latest row per key by a descending column (WN-1)."""
    by = [by] if isinstance(by, str) else list(by)
    return distinct_on(df, keys, [(b, "desc_nulls_last") if isinstance(b, str) else b for b in by])


def current_pointer(revisions: DataFrame, key: str, rev: str, out: str = "rev") -> DataFrame:
    """Header pointer = highest revision per entity (Q-2 corrected form: max(rev))."""
    return revisions.groupBy(key).agg(F.max(rev).alias(out))


def current_revision(headers: DataFrame, revisions: DataFrame, keys: Sequence[str],
                     header_rev: str = "rev", rev_rev: str = "rev") -> DataFrame:
    """Keep only the revision each header points to: inner equi-join on (keys, rev) (BO-1)."""
    h, r = headers.alias("_h"), revisions.alias("_r")
    cond = [F.col(f"_h.{k}") == F.col(f"_r.{k}") for k in keys] + [
        F.col(f"_h.{header_rev}") == F.col(f"_r.{rev_rev}")]
    joined = h.join(r, cond, "inner")
    extra = [c for c in revisions.columns if c not in set(keys) | {rev_rev} and c not in headers.columns]
    return joined.select(*[F.col(f"_h.{c}") for c in headers.columns], *[F.col(f"_r.{c}") for c in extra])


def revision_full_join(headers: DataFrame, revisions: DataFrame, key: str,
                       header_rev: str = "rev", rev_key: str | None = None,
                       rev_rev: str = "rev") -> DataFrame:
    """FULL JOIN of headers and revisions on (id, rev) with COALESCEd keys (JN-6, Q-1).

    Every superseded revision survives with NULL header columns, exactly as the
    reference's staging model does."""
    rev_key = rev_key or key
    h = headers.alias("h")
    r = revisions.alias("r")
    joined = h.join(r, (F.col(f"h.{key}") == F.col(f"r.{rev_key}"))
                    & (F.col(f"h.{header_rev}") == F.col(f"r.{rev_rev}")), "full_outer")
    return joined.select(
        F.coalesce(F.col(f"h.{key}"), F.col(f"r.{rev_key}")).alias(key),
        F.coalesce(F.col(f"h.{header_rev}"), F.col(f"r.{rev_rev}")).alias("rev"),
        *[F.col(f"h.{c}") for c in headers.columns if c not in (key, header_rev)],
        *[F.col(f"r.{c}") for c in revisions.columns if c not in (rev_key, rev_rev)
          and c not in headers.columns],
    )


def pointed_revisions(headers: DataFrame, lines: DataFrame, key: str, rev: str, order: Sequence) -> tuple[DataFrame, DataFrame]:
    """Headers with their pointer, the highest revision of their ``key``, as ``_ptr``, and the first row of each (key, rev) by ``order``.

    The pointer is a grouped maximum: each task sends one row per key. The first rows are dealt by key *and* revision. So an entity may have
    any share of all revisions: none of the two steps, nor the join on both columns, brings them to one task."""
    pointer = lines.groupBy(key).agg(F.max(rev).alias("_ptr"))
    return headers.join(pointer, key, "left"), distinct_on(lines, [key, rev], order)


def revision_full_join_pointed(headers: DataFrame, revs: DataFrame, key: str, rev: str = "rev", ptr: str = "_ptr") -> DataFrame:
    """FULL JOIN of headers, which carry their pointer, with every revision (JN-6, Q-1): a header meets the
    revision it points to; superseded revisions keep NULL header columns and headers without any
    revision keep a NULL revision."""
    h, r = headers.alias("_h"), revs.alias("_r")
    j = h.join(r, (F.col(f"_h.{key}") == F.col(f"_r.{key}")) & (F.col(f"_h.{ptr}") == F.col(f"_r.{rev}")), "full_outer")
    return j.select(
        F.coalesce(F.col(f"_h.{key}"), F.col(f"_r.{key}")).alias(key),
        F.col(f"_r.{rev}").alias(rev),
        *[F.col(f"_h.{c}") for c in headers.columns if c not in (key, ptr)],
        *[F.col(f"_r.{c}") for c in revs.columns if c not in (key, rev) and c not in headers.columns])
