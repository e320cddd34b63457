"""Projection, filters, search, ordering and paging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import search_fold
from .skew import ranged


def project_typed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rename, type and flag; empty text becomes NULL in every text column."""
    out = df.select(*[c.alias(n) for n, c in columns.items()])
    texts = {n for n, ty in out.dtypes if ty == "string"}
    return out.select(*[F.nullif(F.col(n), F.lit("")).alias(n) if n in texts else F.col(n) for n in out.columns])


def board_scope(season: str, career_view: str, group: str, category_known: str, is_regular: str,
                main_groups: Sequence[str] = ("",)) -> Column:
    """Rows of a regular-season board of a real season, in the main group and a known category."""
    return (~F.col(career_view) & F.col(group).isin(*main_groups) & F.col(category_known)
            & F.col(season).rlike(r"^\d{4}$") & F.col(is_regular))


def in_year_range(year: Column, lo: int | None, hi: int | None) -> Column:
    """Rows whose year is unknown pass: the filter only removes what it can judge."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (year >= lo)
    if hi is not None:
        cond = cond & (year <= hi)
    return year.isNull() | cond


def dataset_query(df: DataFrame, order: Sequence[Column], year: str | None = None, year_from: int | None = None,
                  year_to: int | None = None, club: str | None = None, club_columns: Sequence[str] = (),
                  contains: str | None = None, limit: int | None = None) -> DataFrame:
    """The archive's query form: year range, club, free text over the whole row, limit."""
    out = df
    if year and (year_from is not None or year_to is not None):
        out = out.where(in_year_range(F.col(year), year_from, year_to))
    if club:
        where = F.concat_ws(" ", *(club_columns or df.columns))
        out = out.where(F.contains(search_fold(where), search_fold(F.lit(club))))
    if contains:
        out = out.where(F.contains(search_fold(F.concat_ws(" ", *df.columns)), search_fold(F.lit(contains))))
    return out if limit is None else out.orderBy(*order).limit(limit)


class Dataset(NamedTuple):
    """A named dataset of the query form: its rows, full order, and which columns hold year and club."""

    rows: DataFrame
    order: Sequence[Column]
    year: str | None = None
    club_columns: Sequence[str] = ()


def query_named(datasets: Mapping[str, Dataset], name: str, **filters) -> DataFrame:
    """`dataset_query` over a dataset picked by name; an unknown name is an error that lists the known ones."""
    if name not in datasets:
        raise KeyError(f"no dataset {name!r}; there are {sorted(datasets)}")
    d = datasets[name]
    return dataset_query(d.rows, d.order, year=d.year, club_columns=d.club_columns, **filters)


def token_search(df: DataFrame, columns: Sequence[str], words: str) -> DataFrame:
    """Every word of the query occurs somewhere in the folded text."""
    folded = search_fold(F.concat_ws(" ", *columns))
    wanted = F.filter(F.split(search_fold(F.lit(words)), " "), lambda w: w != "")
    return df.where(F.forall(wanted, lambda w: F.contains(folded, w)))


def facet_search(df: DataFrame, tags: Column, facet: str | None, columns: Sequence[str], text: str) -> DataFrame:
    out = df if facet is None else df.where(F.array_contains(tags, facet))
    return out.where(F.contains(search_fold(F.concat_ws(" ", *columns)), search_fold(F.lit(text))))


def select_captures(df: DataFrame, keep: Column, noise: Sequence[str], url: str) -> DataFrame:
    """Captures that meet the selection and match no noise pattern."""
    noisy = reduce(lambda a, b: a | b, [F.col(url).rlike(p) for p in noise], F.lit(False))
    return df.where(keep & ~noisy)


def possible_and_certain(df: DataFrame, keys: Sequence[str], facts: Mapping[str, Column]) -> DataFrame:
    """Per group how many rows a fact may hold for (true or unknown) and surely holds for."""
    aggs = [F.count("*").alias("n_rows")]
    for name, pred in facts.items():
        aggs += [F.count_if(F.coalesce(pred, F.lit(True))).alias(f"{name}_possible"),
                 F.count_if(F.coalesce(pred, F.lit(False))).alias(f"{name}_certain")]
    return df.groupBy(*keys).agg(*aggs)


def support_floor(df: DataFrame, keys: Sequence[str], resolved: Column, min_rows: int, min_share: float) -> DataFrame:
    """Groups with enough rows and enough of them resolved."""
    return (df.groupBy(*keys)
            .agg(F.count("*").alias("n_rows"), F.avg(resolved.cast("int")).alias("resolved_share"))
            .where((F.col("n_rows") >= min_rows) & (F.col("resolved_share") >= min_share)))


def sort_order(column: str, kind: str, descending: bool = False) -> Column:
    """Table order: unknown sorts lowest; text follows the Spanish alphabet."""
    c = F.collate(F.col(column), "es") if kind == "text" else F.col(column)
    return c.desc_nulls_last() if descending else c.asc_nulls_first()


def numbered_sort(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Row positions of the sorted table, without sorting it in one task. `order` must tell any two rows apart."""
    return ranged(df, order, {name: F.lit(1).cast("long")})


def page(df: DataFrame, order: Sequence[Column], offset: int, size: int, total: str = "n_total") -> DataFrame:
    """One page of a full order, with the count over all rows."""
    n_all = df.agg(F.count("*").alias("n")).scalar()
    return df.orderBy(*order).offset(offset).limit(size).withColumn(total, n_all)


def recent(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
