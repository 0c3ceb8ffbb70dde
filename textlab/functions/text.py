"""Text cleaning steps. Each takes and returns a string column."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, functions as F

from textlab.functions import patterns as P
from textlab.functions.words import emoji_names


def lower_text(text: Column) -> Column:
    return F.lower(text)


def _replace_by_mode(text: Column, pattern: str, mode: str) -> Column:
    """`drop` deletes matches, `token:<t>` writes `<t>`, any other mode leaves the text as it is."""
    if mode == "drop":
        replacement = ""
    elif mode.startswith("token:"):
        replacement = re.sub(r"([\\$])", r"\\\1", mode.split(":", 1)[1])
    else:
        return text
    return F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def replace_urls(text: Column, mode: str = "token:url") -> Column:
    return _replace_by_mode(text, P.URL, mode)


def replace_mentions(text: Column, mode: str = "token:user") -> Column:
    """Run after `replace_urls`, so that an `@` inside a URL is gone already."""
    return _replace_by_mode(text, P.MENTION, mode)


def squeeze_elongation(text: Column) -> Column:
    """A character other than newline that comes three times or more is kept twice."""
    return F.regexp_replace(text, F.lit(P.REPEATED), F.lit("$1$1"))


_BUCKETS = 256


def _emoji_lookup(names: dict[str, str]):
    """Function from a column of keys to their names; a key is looked for among those of its bucket only."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for key, name in names.items():
        buckets[ord(key[0]) % _BUCKETS][key] = name
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    return lambda key: F.try_element_at(F.get(table, F.ascii(key) % _BUCKETS), key)


def _composed_name(emoji: Column) -> Column:
    """Names of the code points of a sequence in a row; letters of a flag and the sign of a keycap after a word."""
    lookup = _emoji_lookup(emoji_names())
    points = F.array_compact(F.transform(F.split(emoji, ""), lookup))
    return (
        F.when(emoji.endswith("\u20e3"), F.concat(F.lit("keycap_"), F.substring(emoji, 1, 1)))
        .when(emoji.rlike(f"^[{chr(P.FLAG_LETTERS[0])}-{chr(P.FLAG_LETTERS[1])}]"), F.concat(F.lit("flag_"), F.array_join(points, "")))
        .when(F.size(points) > 0, F.array_join(points, "_"))
    )


def emoji_to_text(text: Column, names: dict[str, str] | None = None) -> Column:
    """An emoji becomes ` :name: `; emoji without a name stay.

    `names` is a table from emoji, also sequences, to names; the longest one that fits counts, with or without
    variation selectors. Without a table, a sequence (flag, keycap, skin tone, joined emoji) gets one name
    made of the Unicode names of its code points. Only texts that hold an emoji are cut.
    """
    if names is None:
        pattern, name_of = P.EMOJI_SEQUENCE, _composed_name
    else:
        table = {key.replace(P.VARIATION_SELECTOR, ""): name for key, name in names.items()}
        table.pop("", None)
        if not table:
            return text
        pattern, name_of = P.any_emoji_of(list(table)), _emoji_lookup(table)

    def named(found: Column) -> Column:
        name = name_of(F.replace(found, F.lit(P.VARIATION_SELECTOR), F.lit("")))
        return F.coalesce(F.concat(F.lit(" :"), name, F.lit(": ")), found)

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), named)
    whole = F.zip_with(F.split(text, pattern), found, lambda piece, name: F.concat(piece, F.coalesce(name, F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(whole, "")).otherwise(text)


def normalize_whitespace(text: Column) -> Column:
    """Runs of Unicode white space become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, F.lit(P.SPACE + "+"), F.lit(" ")))


def clean_text_b0(text: Column) -> Column:
    """Baseline cleaning: lower case, URL and mention tokens, single blanks."""
    return normalize_whitespace(replace_mentions(replace_urls(lower_text(text))))
