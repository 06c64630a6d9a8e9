"""String, date and identity expressions of the raster catalogue."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name tokens and the product each stands for, (id, type, spectral id), in the order they are tried.
VARIANTS: list[tuple[str, str, str | None]] = [
    ("DSM", "elevation_surface", None),
    ("DEM", "elevation_ground", None),
    ("DTM", "elevation_ground", None),
    ("CHM", "canopy_height", None),
    ("NDVI", "vegetation_index", "ndvi"),
    ("BGR", "color_composite", "bgr"),
    ("RGB", "color_composite", "rgb"),
    ("NIR", "spectral_band", "nir"),
    ("RED", "spectral_band", "red"),
    ("GREEN", "spectral_band", "green"),
    ("BLUE", "spectral_band", "blue"),
    ("SWIR1", "spectral_band", "swir1"),
    ("SWIR2", "spectral_band", "swir2"),
    ("ERIK", "custom", None),
    ("ERIK2", "custom", None),
]
# What a variant is worth as the canonical raster of a bundle.
VARIANT_PRIORITY = {
    "RGB": 100, "BGR": 95, "PANCHRO": 90, "NIR": 85, "RED": 84, "GREEN": 83, "BLUE": 82, "NLL": 70,
    "ERIK": 50, "ERIK2": 49, "NDVI": 40, "CHM": 30, "DSM": 20, "DEM": 20, "DTM": 20,
}
#: Texts that mean "no value" when read.
NULL_MARKERS = ("", "nan", "none", "null")
SHORT_HASH_CHARS = 6


def clean(text: Column) -> Column:
    """Null for blank text and the null markers in any case; else trimmed."""
    trimmed = F.trim(text)
    return F.when(F.lower(trimmed).isin(*NULL_MARKERS), None).otherwise(trimmed)


def number(text: Column) -> Column:
    """The text as a double; null where it is a null marker or no number."""
    return clean(text).try_cast("double")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def variant(path: Column) -> Column:
    """struct<variant_id, variant_type, spectral_id>: the first token that is a
    known product, else the first product named inside the stem, else NLL."""
    upper = F.upper(stem(path))
    ids = [v[0] for v in VARIANTS]
    token = F.get(F.filter(F.split(upper, "[^A-Z0-9]+"), lambda t: t.isin(*ids)), F.lit(0))
    found = F.lit("NLL")
    for name in reversed(ids):
        found = F.when(upper.contains(name), name).otherwise(found)
    chosen = F.coalesce(token, found)
    kind, spectral = F.lit("unknown"), F.lit(None).cast("string")
    for name, of_kind, of_spectral in VARIANTS:
        kind = F.when(chosen == name, of_kind).otherwise(kind)
        spectral = F.when(chosen == name, F.lit(of_spectral)).otherwise(spectral)
    return F.struct(chosen.alias("variant_id"), kind.alias("variant_type"), spectral.alias("spectral_id"))


def acquisition_date(path: Column) -> Column:
    """``yymmdd`` of the first 20YY-MM-DD, else of the first YYMMDD that is a calendar date, else ``nulldate``."""
    name = stem(path)

    def tried(pattern: str, century: str) -> Column:
        parts = [F.regexp_extract(name, pattern, k) for k in (1, 2, 3)]
        return F.date_format(F.try_to_date(F.concat(F.lit(century), *parts), "yyyyMMdd"), "yyMMdd")

    long_form = tried(r"(?<!\d)(20\d{2})[-_]?([01]\d)[-_]?([0-3]\d)(?!\d)", "")
    short_form = tried(r"(?<!\d)(\d{2})([01]\d)([0-3]\d)(?!\d)", "20")
    return F.coalesce(long_form, short_form, F.lit("nulldate"))


def acquired_at(name: Column) -> Column:
    """``20YY-MM-DD`` of a name that begins with YYMMDD, month and day in range; else null."""
    parts = [F.regexp_extract(name, r"^(\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])", k) for k in (1, 2, 3)]
    return F.when(parts[0] != "", F.concat(F.lit("20"), F.concat_ws("-", *parts)))


def slug(text: Column) -> Column:
    bare = F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", ""))
    return F.when(bare == "", "locale").otherwise(bare)


def as_uri(path: Column) -> Column:
    """As it is with a scheme or a virtual file-system prefix, else a file URI of the absolute path."""
    return F.when(path.contains("://") | path.startswith("/vsi"), path).otherwise(F.concat(F.lit("file://"), path))


def from_marker(path: Column, marker: str) -> Column:
    """The path from the first directory called ``marker``; '' if there is none."""
    return F.regexp_extract(path, rf"(?:^|/)({marker}(?:/.*)?)$", 1)


def logical_uri(path: Column, marker: str, scheme: str, member: Column | None = None) -> Column:
    base = F.concat(F.lit(f"{scheme}://"), from_marker(path, marker))
    return base if member is None else F.concat(base, F.lit("!/"), member)


def safe_bucket(bucket: Column) -> Column:
    """Nested bucket path without unsafe components."""
    parts = F.transform(F.split(F.lower(F.trim(bucket)), "/"), lambda p: F.trim(p))
    parts = F.filter(parts, lambda p: ~p.isin("", ".", ".."))
    parts = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(p, "[^a-z0-9_.-]+", "_"), "^[._-]+|[._-]+$", ""))
    joined = F.array_join(F.filter(parts, lambda p: p != ""), "/")
    return F.when(joined == "", "unknown").otherwise(joined)


def member_token(text: Column) -> Column:
    """Letters, digits, ``_`` and ``-``; an error if nothing is left."""
    safe = F.regexp_replace(F.regexp_replace(F.trim(text), "[^A-Za-z0-9_-]+", "_"), "^_+|_+$", "")
    return F.when(safe == "", F.raise_error(F.lit("invalid measurement variant"))).otherwise(safe)


def tile_id(owner_id: Column, row: Column, col: Column) -> Column:
    return F.concat(F.lit("T"), F.substring(owner_id, 2, 1 << 20), F.format_string("r%04dc%04d", row, col))


def tile_key(alias: Column, row: Column, col: Column) -> Column:
    return F.concat(alias, F.format_string("r%04dc%04d", row, col))


def short_hash(text: Column, size: int = SHORT_HASH_CHARS) -> Column:
    """The first ``size`` hex digits of BLAKE2b with the fewest whole bytes."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(
                [None if t is None else hashlib.blake2b(t.encode(), digest_size=max(1, (size + 1) // 2)).hexdigest()[:size] for t in texts.to_pylist()],
                pa.string(),
            )

    return of(text)


def location_hint(path: Column) -> Column:
    """struct<event_date, name, state, suffix, source> of the deepest ``20YY_MM_DD_rest``
    part; the first token of two capitals is the state. All '' if there is none."""
    pattern = r"^(20\d{2})_(\d{2})_(\d{2})_(.+)$"
    part = F.get(F.filter(F.reverse(F.split(path, "/")), lambda p: p.rlike(pattern)), F.lit(0))
    rest = F.regexp_extract(part, pattern, 4)
    tokens = F.split(rest, "_")
    # Cut the text at the first token of two capitals.
    at = F.array_position(F.transform(tokens, lambda t: t.rlike("^[A-Z]{2}$")), True).cast("int")
    has = at > 0

    def blank(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    def joined(begin: Column, size: Column) -> Column:
        return F.array_join(F.slice(tokens, begin, size), "_")

    date = F.concat_ws("-", *(F.regexp_extract(part, pattern, k) for k in (1, 2, 3)))
    return F.struct(
        F.when(part.isNull(), "").otherwise(date).alias("event_date"),
        blank(F.when(has, joined(F.lit(1), at - 1)).otherwise(rest)).alias("name"),
        blank(F.when(has, F.get(tokens, at - 1))).alias("state"),
        blank(F.when(has, joined(at + 1, F.size(tokens)))).alias("suffix"),
        blank(part).alias("source"),
    )


def location_warning(hint_name: Column, hint_state: Column, name: Column, state: Column) -> Column:
    """``;``-joined mismatches between a folder's hint and a resolved place; blanks compare with nothing."""
    a, b = (F.regexp_replace(F.lower(c), "[^a-z0-9]+", "") for c in (hint_name, name))
    state_differs = (hint_state != "") & (state != "") & (hint_state != state)
    name_differs = (hint_name != "") & (name != "") & ~a.contains(b) & ~b.contains(a)
    return F.concat_ws(";", F.when(state_differs, "state_hint_mismatch"), F.when(name_differs, "location_hint_mismatch"))


def display_name(name: Column, county: Column, state: Column) -> Column:
    return (
        F.when((name != "") & (state != ""), F.concat_ws(", ", name, state))
        .when(name != "", name)
        .when((county != "") & (state != ""), F.concat_ws(", ", county, state))
        .when(state != "", state)
        .otherwise("unknown")
    )


def percent_text(value: Column) -> Column:
    """Whole numbers without a fraction, others with six significant digits."""
    return F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(
        F.regexp_replace(F.regexp_replace(F.format_string("%.6g", value), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    )
