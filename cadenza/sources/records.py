"""Nested song records -> flat numeric rows.

A record holds three groups (``musicbrainz``, ``analysis``, ``metadata``).
Flattening picks the year and 15 doubles by field path, widens the year to
double and replaces NaN by 0 (nulls stay null). Pure column expressions.

Records of any shape are taken apart by their schema: :func:`leaves` lists what a
schema holds at any depth of structs, arrays and maps, :func:`flatten` makes a column
of every leaf outside arrays, and :func:`unnest` makes a row of every element of
an array at any depth, with its place in each array around it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import nan_to_zero

# Fixed field order of a flattened song record (year first, then 15 features).
RECORD_FIELDS = [
    "musicbrainz.year",
    "analysis.danceability", "analysis.duration", "analysis.end_of_fade_in",
    "analysis.energy", "analysis.key_confidence", "analysis.loudness",
    "analysis.mode_confidence", "analysis.start_of_fade_out", "analysis.tempo",
    "analysis.time_signature_confidence",
    "metadata.artist_familiarity", "metadata.artist_hotttnesss", "metadata.artist_latitude",
    "metadata.artist_longitude", "metadata.song_hotttnesss",
]


def flat_name(path: str) -> str:
    return path.split(".")[-1]


def flatten_records(df: DataFrame, fields: list[str] = RECORD_FIELDS, keep: list[str] = (),
                    nan_zero: bool = True) -> DataFrame:
    """One double column per field path (named by its last segment)."""
    cols = []
    for p in fields:
        c = F.col(p).cast("double")
        cols.append((nan_to_zero(c) if nan_zero else c).alias(flat_name(p)))
    return df.select(*keep, *cols)


def known_year(df: DataFrame, year_col: str = "year", unknown: float = 0.0) -> DataFrame:
    """Drop rows whose year is the 'unknown' sentinel (tested as a number)."""
    return df.filter(F.col(year_col) != F.lit(unknown))


def as_vector(df: DataFrame, fields: list[str] = RECORD_FIELDS, out: str = "value",
              keep: list[str] = ()) -> DataFrame:
    """The flattened values as one ``array<double>`` (year first), the input
    of the song feature pipeline without a tokenizer."""
    names = [flat_name(p) for p in fields]
    return df.select(*keep, F.array(*[F.col(n) for n in names]).alias(out))


# --- records of any shape --------------------------------------------------------------

@dataclass(frozen=True)
class Leaf:
    """A value that holds no other: its path, type and the arrays around it (paths)."""

    path: tuple[str, ...]
    type: T.DataType
    arrays: tuple[tuple[str, ...], ...]


def _element(kind: T.DataType) -> T.DataType | None:
    """What an array holds; a map is an array of (key, value)."""
    if isinstance(kind, T.ArrayType):
        return kind.elementType
    if isinstance(kind, T.MapType):
        return T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
    return None


def leaves(schema: T.DataType, path: tuple[str, ...] = (), arrays: tuple = ()) -> list[Leaf]:
    """All leaves of a schema, in its order. An array's elements have its path."""
    if isinstance(schema, T.StructType):
        return [x for f in schema.fields for x in leaves(f.dataType, (*path, f.name), arrays)]
    element = _element(schema)
    return [Leaf(path, schema, arrays)] if element is None else leaves(element, path, (*arrays, path))


def _named(paths: list[tuple[str, ...]], taken: list[str]) -> list[str]:
    """A column name per path: its last part where that is unique, else as many
    parts as it takes, joined by one underscore."""
    out: list[str] = []
    used = {t.lower() for t in taken}
    for p in paths:
        n = 1
        while n < len(p) and sum(q[-n:] == p[-n:] for q in paths) > 1:
            n += 1
        name = "_".join(p[-n:])
        while name.lower() in used:
            n += 1
            name = "_".join(p[-n:]) if n <= len(p) else f"{name}_"
        used.add(name.lower())
        out.append(name)
    return out


def _at(base: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        base = base.getField(name)
    return base


def flatten(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``keep`` and a column for every leaf outside arrays. A null struct gives nulls."""
    found = [x for x in leaves(df.select(*(f"`{c}`" for c in df.columns if c not in keep)).schema) if not x.arrays]
    names = _named([x.path for x in found], list(keep))
    return df.select(*(f"`{c}`" for c in keep),
                     *(_at(F.col(f"`{x.path[0]}`"), x.path[1:]).alias(n) for x, n in zip(found, names)))


def unnest(df: DataFrame, path: str | tuple[str, ...], keep: list[str] = (), outer: bool = False) -> DataFrame:
    """A row for every element of the array (or map) at ``path``: ``keep``, the
    element's place in each array around it (``<array>_pos``, from 0) and a column for
    every leaf of the element outside further arrays. With ``outer``, a record whose
    array is empty or null at any depth has one row of nulls."""
    path = tuple(path.split(".")) if isinstance(path, str) else tuple(path)
    inner = "_at"
    while any(c.lower().startswith(inner) for c in df.columns):
        inner = f"_{inner}"
    rows, base, kind, walked, places = df, None, df.schema, (), []
    for name in path:
        if not isinstance(kind, T.StructType) or name not in kind.names:
            raise ValueError(f"no field {'.'.join((*walked, name))}; there are {getattr(kind, 'names', [])}")
        kind, walked = kind[name].dataType, (*walked, name)
        base = F.col(f"`{name}`") if base is None else base.getField(name)
        while (element := _element(kind)) is not None:
            pos, value = f"{inner}{len(places)}", f"{inner}{len(places)}_value"
            explode = F.posexplode_outer if outer else F.posexplode
            rows = rows.select("*", explode(F.map_entries(base) if isinstance(kind, T.MapType) else base).alias(pos, value))
            places.append((f"{name}_pos", pos))
            base, kind = F.col(value), element
    if not places:
        raise ValueError(f"{'.'.join(path)} is no array")
    taken, pos_names = list(keep), []
    for name, _ in places:
        while name in taken:
            name += "_inner"
        pos_names.append(name)
        taken.append(name)
    found = [x for x in leaves(kind) if not x.arrays]
    names = _named([x.path or (path[-1],) for x in found], taken)
    return rows.select(*(f"`{c}`" for c in keep), *(F.col(p).alias(n) for (_, p), n in zip(places, pos_names)),
                       *(_at(base, x.path).alias(n) for x, n in zip(found, names)))
