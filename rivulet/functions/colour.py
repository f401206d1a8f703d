"""Colours as structs or columns of channels from 0 to 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two inks, near-white, the neutral range, and the profiles' thresholds.
BLUE, GOLD = "blue", "gold"
PROFILES = ("legacy-v1", "cyan-gold-v1", "nonblack-gold-v1")
NEAR_WHITE, NEUTRAL = 0.96, 0.10


def is_neutral(r: Column, g: Column, b: Column) -> Column:
    """Channels within 0.10 of each other; null is not neutral."""
    return F.coalesce((F.greatest(r, g, b) - F.least(r, g, b) < NEUTRAL) & r.isNotNull() & g.isNotNull() & b.isNotNull(), F.lit(False))


def key(r: Column, g: Column, b: Column) -> Column:
    """Channels to two decimals, half to even; null stays null."""
    return F.when(r.isNotNull(), F.struct(*[F.bround(c, 2).alias(n) for c, n in ((r, "r"), (g, "g"), (b, "b"))]))


def classify(r: Column, g: Column, b: Column, profile: str = "legacy-v1") -> Column:
    """blue, gold or same; an unknown profile is an error."""
    if profile not in PROFILES:
        raise ValueError(f"unknown colour profile: {profile}")
    spread = F.greatest(r, g, b) - F.least(r, g, b)
    white = F.least(r, g, b) >= NEAR_WHITE
    to_blue = {
        "nonblack-gold-v1": spread < NEUTRAL,
        "cyan-gold-v1": ~((g > 0.6) & (b > 0.6) & (r < 0.4)),
        "legacy-v1": (spread < NEUTRAL) | ((b > r + 0.08) & (b >= g)),
    }[profile]
    return F.when(white, "same").when(to_blue, BLUE).otherwise(GOLD)


def ink(r: Column, g: Column, b: Column, keep_blue: Column, in_rail: Column) -> Column:
    """House rule: the right column, neutrals and the body colours are blue, the rest gold; null stays null.

    ``keep_blue``: array of colour keys.
    """
    blue = in_rail | is_neutral(r, g, b) | F.coalesce(F.array_contains(keep_blue, key(r, g, b)), F.lit(False))
    return F.when(r.isNull(), None).when(blue, BLUE).otherwise(GOLD)


def template_ink(r: Column, g: Column, b: Column, golds: Column, blues: Column) -> Column:
    """Template rule: forced gold keys first; neutrals and listed keys blue; the rest gold."""
    k = key(r, g, b)
    return (
        F.when(r.isNull(), None)
        .when(F.coalesce(F.array_contains(golds, k), F.lit(False)), GOLD)
        .when(is_neutral(r, g, b) | F.coalesce(F.array_contains(blues, k), F.lit(False)), BLUE)
        .otherwise(GOLD)
    )


def from_cmyk(c: Column, m: Column, y: Column, k: Column) -> Column:
    one = F.lit(1.0)
    return F.struct(*[(1 - F.least(one, v + k)).alias(n) for v, n in ((c, "r"), (m, "g"), (y, "b"))])


def from_gray(v: Column) -> Column:
    return F.struct(v.alias("r"), v.alias("g"), v.alias("b"))


def parse_hex(text: Column) -> Column:
    """#rgb or #rrggbb as channels; null otherwise."""
    h = F.lower(F.regexp_extract(text, "^#([0-9A-Fa-f]{6}|[0-9A-Fa-f]{3})$", 1))
    long = F.when(F.length(h) == 3, F.regexp_replace(h, "(.)", "$1$1")).otherwise(h)
    channel = lambda i: F.conv(F.substring(long, i, 2), 16, 10).cast("double") / 255
    return F.when(h != "", F.struct(channel(1).alias("r"), channel(3).alias("g"), channel(5).alias("b")))


def recolour_hex(text: Column, profile: str = "legacy-v1", blue: str = "#0b3f8f", gold: str = "#d99a00") -> Column:
    """Every hex colour in a text replaced by its ink; near-white stays.

    The text is taken apart at its colours and put together again, all in one expression.
    """
    pattern = "#(?:[0-9A-Fa-f]{6}|[0-9A-Fa-f]{3})(?![0-9A-Za-z])"
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

    def new(x: Column) -> Column:
        c = parse_hex(x)
        kind = classify(c["r"], c["g"], c["b"], profile)
        return F.when(kind == BLUE, blue).when(kind == GOLD, gold).otherwise(x)

    between = F.split(text, pattern, -1)
    return F.array_join(F.flatten(F.zip_with(between, F.transform(found, new), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
