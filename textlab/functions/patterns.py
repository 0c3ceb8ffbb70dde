"""Character classes and patterns.

Java's `\\w`, `\\s` and `\\b` are ASCII by default, so the classes are spelled out.
"""

import re

# The classes a Unicode-aware `\w`, `\s` and `\S` stand for.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"

URL = rf"https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
MENTION = rf"@{WORD}+"
REPEATED = r"([^\n])\1{2,}"

CLITIC = "'(?:s|m|re|ve|ll|d)"
WORD_TOKEN = rf"(?i)n't|{CLITIC}|{WORD}+|{NOT_SPACE}"
VECTOR_TOKEN = WORD + "{2,}"

# The code point ranges that make the emoji signal.
EMOJI_RANGES = ((0x1F300, 0x1FAFF), (0x2600, 0x27BF), (0x1F1E6, 0x1F1FF))
EMOJI = "[" + "".join(f"{chr(first)}-{chr(last)}" for first, last in EMOJI_RANGES) + "]"
VARIATION_SELECTOR = "\ufe0f"

# The code points with Unicode's Emoji property, without digits, `#`, `*` and the flag letters.
EMOJI_POINTS = """
a9 ae 203c 2049 2122 2139 2194-2199 21a9-21aa 231a-231b 2328 23cf 23e9-23f3 23f8-23fa 24c2 25aa-25ab 25b6 25c0 25fb-25fe
2600-2604 260e 2611 2614-2615 2618 261d 2620 2622-2623 2626 262a 262e-262f 2638-263a 2640 2642 2648-2653 265f-2660 2663
2665-2666 2668 267b 267e-267f 2692-2697 2699 269b-269c 26a0-26a1 26a7 26aa-26ab 26b0-26b1 26bd-26be 26c4-26c5 26c8
26ce-26cf 26d1 26d3-26d4 26e9-26ea 26f0-26f5 26f7-26fa 26fd 2702 2705 2708-270d 270f 2712 2714 2716 271d 2721 2728
2733-2734 2744 2747 274c 274e 2753-2755 2757 2763-2764 2795-2797 27a1 27b0 27bf 2934-2935 2b05-2b07 2b1b-2b1c 2b50 2b55
3030 303d 3297 3299 1f004 1f0cf 1f170-1f171 1f17e-1f17f 1f18e 1f191-1f19a 1f201-1f202 1f21a 1f22f 1f232-1f23a 1f250-1f251
1f300-1f321 1f324-1f393 1f396-1f397 1f399-1f39b 1f39e-1f3f0 1f3f3-1f3f5 1f3f7-1f4fd 1f4ff-1f53d 1f549-1f54e 1f550-1f567
1f56f-1f570 1f573-1f57a 1f587 1f58a-1f58d 1f590 1f595-1f596 1f5a4-1f5a5 1f5a8 1f5b1-1f5b2 1f5bc 1f5c2-1f5c4 1f5d1-1f5d3
1f5dc-1f5de 1f5e1 1f5e3 1f5e8 1f5ef 1f5f3 1f5fa-1f64f 1f680-1f6c5 1f6cb-1f6d2 1f6d5-1f6d7 1f6dc-1f6e5 1f6e9 1f6eb-1f6ec
1f6f0 1f6f3-1f6fc 1f7e0-1f7eb 1f7f0 1f90c-1f93a 1f93c-1f945 1f947-1f9ff 1fa70-1fa7c 1fa80-1fa89 1fa8f-1fac6 1face-1fadc
1fadf-1fae9 1faf0-1faf8
"""
FLAG_LETTERS = (0x1F1E6, 0x1F1FF)
JOINER = "\u200d"


def emoji_ranges() -> list[tuple[int, int]]:
    ends = [part.split("-") for part in EMOJI_POINTS.split()]
    return [(int(part[0], 16), int(part[-1], 16)) for part in ends]


def _emoji_sequence() -> str:
    """Flags, keycaps, and emoji with a selector, a skin tone or tags, alone or joined.

    The look ahead is for speed: it rules out most characters by four ranges.
    """
    point = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in emoji_ranges()) + "]"
    part = f"{point}(?:[\U0001f3fb-\U0001f3ff]|{VARIATION_SELECTOR})?(?:[\U000e0020-\U000e007f]+)?"
    letter = f"[{chr(FLAG_LETTERS[0])}-{chr(FLAG_LETTERS[1])}]"
    return f"[0-9#*]{VARIATION_SELECTOR}?\u20e3|{letter}{{2}}|(?=[\xa9\xae\u203c-\u3299\U0001f004-\U0001faff]){part}(?:{JOINER}{part})*"


EMOJI_SEQUENCE = _emoji_sequence()


def any_emoji_of(keys: list[str]) -> str:
    """Pattern of the longest key that matches; a variation selector may follow each code point."""
    spelled = ["".join(re.escape(c) + VARIATION_SELECTOR + "?" for c in key) for key in sorted(keys, key=len, reverse=True)]
    single = [re.escape(key) for key in keys if len(key) == 1]
    longer = [s for s, key in zip(spelled, sorted(keys, key=len, reverse=True)) if len(key) > 1]
    alternatives = longer + ([f"[{''.join(single)}]{VARIATION_SELECTOR}?"] if single else [])
    first = "".join(re.escape(c) for c in sorted({key[0] for key in keys}))
    return f"(?=[{first}])(?:{'|'.join(alternatives)})"


def whole_words(words: str) -> str:
    """Case-insensitive pattern for alternatives that stand between word boundaries.

    The look at the first letter is for speed: it rules out most places of a text at once.
    """
    first = "".join(sorted({word[0] for word in words.split("|")}))
    return rf"(?iu)(?=[{first}])(?<!{WORD})(?:{words})(?!{WORD})"
