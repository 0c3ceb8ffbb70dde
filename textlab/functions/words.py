"""Word lists and the emoji names; every function that uses one also takes another as a parameter."""

from __future__ import annotations

import unicodedata

from textlab.functions.patterns import FLAG_LETTERS, emoji_ranges

# Negators that survive stop-word removal.
NEGATORS = [
    "no", "not", "never", "n't", "nobody", "nothing",
    "neither", "nor", "none", "cannot", "without",
]

# Default English function words; pass your own list where another is wanted.
STOP_WORDS = (
    """
    a about above after again against all also am an and any are as at be because been before
    being below between both but by can cannot could did do does doing down during each else ever
    few for from further get had has have having he her here hers herself him himself his how
    however i if in into is it its itself just made many may me might more most much must my
    myself neither never no nobody none nor not nothing now of off often on once one only or other
    others our ours ourselves out over own perhaps please quite rather really same she should
    since so some still such than that the their theirs them themselves then there these they this
    those though through thus to too toward under until up upon us very was we well were what when
    where which while who whom whose why will with within without would yet you your yours
    yourself yourselves
    """.split()
    + ["n't", "'s", "'m", "'re", "'ve", "'ll", "'d"]
)


def emoji_names() -> dict[str, str]:
    """Single code point -> Unicode character name in lower case with underscores; a flag letter -> the letter."""
    names = {}
    for first, last in emoji_ranges():
        for point in range(first, last + 1):
            name = unicodedata.name(chr(point), "")
            if name:
                names[chr(point)] = name.lower().replace(" ", "_")
    first, last = FLAG_LETTERS
    return names | {chr(point): chr(ord("a") + point - first) for point in range(first, last + 1)}
