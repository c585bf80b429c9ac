"""Tags and attributes of roads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The classes that are kept, and the speeds of symbolic tags.
ROAD_CLASSES = (
    "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link",
    "unclassified", "residential", "living_street", "service",
)
SYMBOLIC_SPEEDS = {"pl:urban": 50, "pl:rural": 90, "pl:trunk": 120, "pl:motorway": 140, "pl:living_street": 20, "walk": 5}
MPH = 1.609344


def is_road_class(highway: Column) -> Column:
    return highway.isin(*ROAD_CLASSES)


def display_name(name: Column, highway: Column) -> Column:
    kind = F.when(highway.endswith("_link"), "link").otherwise("road")
    return F.when(F.trim(F.coalesce(name, F.lit(""))) == "", F.concat(F.lit("Unnamed "), kind, F.lit(" ("), highway, F.lit(")"))).otherwise(name)


def _lookup(table: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def leading_number(text: Column) -> tuple[Column, Column]:
    """The number that the first digit of a text begins (null without a digit), and what follows it, without space before."""
    from_digit = F.regexp_replace(text, "^[^0-9]+", "")
    digits = F.regexp_extract(from_digit, "^[0-9]+([.][0-9]+)?", 0)
    return digits.try_cast("double"), F.ltrim(F.substr(from_digit, F.length(digits) + 1))


def maxspeed(value: Column, highway: Column, defaults: dict[str, int]) -> Column:
    """struct<value_kmh, source, raw> of a speed tag; of several values, parted by semicolons, the first counts.

    A symbol has its fixed speed. A number counts as km/h unless mph follows it, is rounded half to even, and must lie within 5 and
    140. Without a tag, and where a tag says neither, the speed is the default of the road's class.
    """
    raw = F.nullif(F.trim(value), F.lit(""))
    tagged = F.coalesce(F.lower(raw) != "nan", F.lit(False))
    said = F.lower(F.trim(F.substring_index(raw, ";", 1)))
    symbol = F.when(tagged, _lookup(SYMBOLIC_SPEEDS, said))
    number, rest = leading_number(said)
    miles = F.startswith(rest, F.lit("mph"))
    speed = F.bround(number * F.when(miles, F.lit(MPH)).otherwise(1.0))
    numeric = F.when(tagged & (speed >= 5) & (speed <= 140), speed.cast("int"))
    kmh = F.coalesce(symbol, numeric, _lookup(defaults, highway), F.lit(50))
    # Where a speed comes from.
    source = (
        F.when(~tagged, "IMPUTED_HIGHWAY_DEFAULT").when(symbol.isNotNull(), "OSM_SYMBOLIC_TAG").when(numeric.isNull(), "IMPUTED_UNPARSEABLE_TAG")
        .when(miles, "OSM_NUMERIC_MPH_CONVERTED").otherwise("OSM_NUMERIC_KMH")
    )
    return F.struct(kmh.alias("value_kmh"), source.alias("source"), raw.alias("raw"))


def other_tag(tags: Column, key: str) -> Column:
    """The value of a key in quoted "key"=>"value" text, with escapes undone; null if there is none."""
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    literal = "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in quoted)
    # a key begins the text or follows a comma that follows a whole pair
    pattern = r'^(?:\s*"(?:[^"\\]|\\.)*"=>"(?:[^"\\]|\\.)*"\s*,)*?\s*"' + literal + r'"=>"((?:[^"\\]|\\.)*)"'
    found = F.regexp_extract(tags, pattern, 1)
    return F.when(tags.rlike(pattern), F.regexp_replace(F.regexp_replace(found, r'\\"', '"'), r"\\\\", r"\\"))


def is_oneway(tag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(tag)).isin("true", "1", "yes", "-1"), F.lit(False))


def is_oneway_reversed(tag: Column) -> Column:
    return F.coalesce(F.trim(tag) == "-1", F.lit(False))


def first_of(values: Column, default: Column | None = None) -> Column:
    """The first of a list, or the default if there is none."""
    head = F.get(values, F.lit(0))
    return head if default is None else F.coalesce(head, default)


def feature_id(u: Column, v: Column, key: Column, wkb: Column) -> Column:
    return F.concat_ws(":", F.lit("osm"), u.cast("string"), v.cast("string"), key.cast("string"), F.substring(F.sha2(wkb, 256), 1, 16))


def coverage_class(samples: Column, supported: Column) -> Column:
    return F.when(F.coalesce(samples, F.lit(0)) == 0, "NONE").when(F.coalesce(supported, F.lit(False)), "SUPPORTED").otherwise("OBSERVED")
