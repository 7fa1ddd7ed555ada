"""Column work on wide frames. Each function is one ``select``, however many columns there are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from visitrec.functions import blank_to_null, column, first_ticked, to_integer
from visitrec.functions.codes import TYPE_CODES


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty strings to null in every text column."""
    return df.select(
        *[
            blank_to_null(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def integers_by_suffix(df: DataFrame, suffix: str = "_complete") -> DataFrame:
    """Columns whose name ends with ``suffix``, in any letter case, become integers."""
    return df.select(
        *[
            to_integer(c).alias(c) if c.lower().endswith(suffix.lower()) else column(c)
            for c in df.columns
        ]
    )


def keys_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *[column(key) for key in keys],
        *[column(c) for c in df.columns if c not in keys],
    )


def drop_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that must be there: an identifier that is not found must stop the run."""
    require_columns(df, names)
    return df.drop(*names)


def checkbox_columns(prefix: str, codes: Sequence[int] = TYPE_CODES) -> list[str]:
    return [f"{prefix}___{code}" for code in codes]


def collapse_checkboxes(
    df: DataFrame, prefixes: Sequence[str], codes: Sequence[int] = TYPE_CODES
) -> DataFrame:
    """Each checkbox group becomes one integer column at the end; its boxes are dropped."""
    boxes = [name for prefix in prefixes for name in checkbox_columns(prefix, codes)]
    require_columns(df, boxes)
    gone = {*boxes, *prefixes}
    return df.select(
        *[column(c) for c in df.columns if c not in gone],
        *[first_ticked(prefix, codes).alias(prefix) for prefix in prefixes],
    )


def form_columns(
    df: DataFrame,
    forms: Sequence[str],
    dictionary: Mapping[str, Sequence[str]],
    always: Sequence[str] = (),
) -> DataFrame:
    """The fields of the named forms, each form followed by ``<form>_complete``.

    ``dictionary`` lists the fields of each form. A checkbox field stands for its ``<field>___<code>``
    columns.
    """
    boxes: dict[str, list[str]] = {}
    for name in df.columns:
        field, mark, _ = name.partition("___")
        if mark:
            boxes.setdefault(field, []).append(name)
    wanted = list(always)
    for form in forms:
        if form not in dictionary:
            raise ValueError(f"form not in the dictionary: {form}")
        for field in dictionary[form]:
            wanted.extend(boxes.get(field, [field]))
        wanted.append(f"{form}_complete")
    unique = list(dict.fromkeys(wanted))
    require_columns(df, unique)
    return df.select(*[column(name) for name in unique])


def rename_headers(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by a given mapping; Spark ignores unknown names, so they are checked first."""
    require_columns(df, list(mapping))
    renamed = [mapping.get(c, c) for c in df.columns]
    if len(set(renamed)) != len(renamed):
        raise ValueError("the mapping gives two columns one name")
    return df.withColumnsRenamed(dict(mapping))
