"""Ingredient lists as chains of native column functions.

The whole cleaning works on the complete string with regular expressions that stop
at the separators, so it runs in generated code; only the final token filter is a
higher-order function. There is no Python in the path.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: they decide which ingredients exist -----------------------

#: What counts as white space (the Unicode set, spelled out for any regex dialect).
SPACE = (r"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
LINE_SPACE = SPACE.replace("[ ", "[")
#: The same characters one by one.
SPACE_CHARACTERS = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
                    + "\u2028\u2029\u202f\u205f\u3000")
DIGIT = r"\p{Nd}"
BLANK = "[ ]"

#: List headings, removed one after the other from the start of the text.
HEADINGS = (
    r"ingredients\s*[/:;,]?\s*inci\s*:\s*",
    r"ingredients\s*/[^:]+:\s*",
    r"ingredients\s*[/:;]\s*",
    r"ingredients\s*:\s*",
    r"ingredients\s+",
    r"inci\s*:\s*",
    r"inci\s+",
)

#: Bracketed repetitions of the word for water.
WATER_WORDS = ("Aqua", "Water", "Eau")

#: Characters that separate ingredients besides the comma.
SEPARATORS = "|*·•."

#: Token patterns that mark a footnote instead of an ingredient.
FOOTNOTES = (
    r"^[\*\.\-\d\s]+$",
    r"HERGESTELLT",
    r"ATHERISCH",
    r"BIO-ZUTAT",
    r"NATURLICH",
    r"EXCLUSIVE.*COMPLEX",
    r"^[A-Z]+'S\s",
    r"PPM\)?$",
    r"PPB\)?$",
    r"^\d+\s*%$",
    r"^\d+PPM",
    r"^\d+\s",
)

#: Colour index numbers.
COLOUR_INDEX = r"^CI\s+\d+$"

MIN_TOKEN_LENGTH = 3

#: Names of one substance.
SYNONYMS = {
    "WATER": "AQUA",
    "EAU": "AQUA",
    "AQUA/WATER": "AQUA",
    "WATER/AQUA": "AQUA",
    "AQUA/WATER/EAU": "AQUA",
    "WATER/AQUA/EAU": "AQUA",
    "DEIONIZED WATER": "AQUA",
    "PURIFIED WATER": "AQUA",
    "DISTILLED WATER": "AQUA",
    "WATERAQUAEAU": "AQUA",
    "WASSERAQUAEAU": "AQUA",
    "AQUA (WATER)": "AQUA",
    "WATER (AQUA)": "AQUA",
    "WATER (AQUA/EAU)": "AQUA",
    "AQUA (WATER/EAU)": "AQUA",
    "AQUA/[WATER]": "AQUA",
    "AQUA [WATER]": "AQUA",
    "WATER [AQUA]": "AQUA",
    "WATER/EAU (AQUA)": "AQUA",
}

# --- Building blocks ---------------------------------------------------------

#: Stands for a comma inside a chemical name; a private-use character, one wide.
HELD_COMMA = "\ue000"


def unicode_classes(pattern: str, space: str = SPACE) -> str:
    r"""``pattern`` with ``\s`` and ``\d`` widened to Unicode white space and digits.
    ``space`` may be a narrower class for text that is known to hold less."""
    out, in_set, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two == r"\s":
            out.append(space[1:-1] if in_set else space)
        elif two == r"\d":
            out.append(DIGIT)
        elif two[0] == "\\":
            out.append(two)
        else:
            in_set = pattern[i] == "[" or (in_set and pattern[i] != "]")
            out.append(pattern[i])
            i += 1
            continue
        i += 2
    return "".join(out)


def _replace(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def _quote(literal: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != " " else c for c in literal)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` knows only U+0020)."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def collapse_space(text: Column) -> Column:
    """Every run of white space, line breaks included, becomes one blank.
    Null or blank text becomes empty."""
    # A lone blank, the usual case, matches nothing and is not rewritten.
    collapsed = _replace(text, rf" *{LINE_SPACE}{SPACE}*| {{2,}}", " ")
    return F.coalesce(F.nullif(collapsed, F.lit(" ")), F.lit(""))


def flatten_lines(text: Column) -> Column:
    r"""``\n`` to a blank, then strip."""
    return strip(F.replace(text, F.lit("\n"), F.lit(" ")))


# From here on the text has been through ``collapse_space``: blanks are its only
# white space, so ``trim`` strips it and the patterns need no wider class.


def strip_heading(text: Column) -> Column:
    for heading in HEADINGS:
        text = F.trim(_replace(text, r"(?iu)\A" + unicode_classes(heading, BLANK)))
    return text


def drop_water_brackets(text: Column) -> Column:
    # The second choice keeps a bracket that is never closed and steps over it at once.
    for word in WATER_WORDS:
        text = _replace(text, rf"(?iu)\({word}[^)]*+\)|(\({word}[^)]*+)", "$1")
    return text


def unify_separators(text: Column) -> Column:
    return _replace(text, f" *[{_quote(SEPARATORS)}] *", ",")


def hold_commas(text: Column) -> Column:
    """Protect a comma between two digits. Matches do not overlap, so of ``1,2,3``
    only the first comma is held."""
    return _replace(text, f"({DIGIT}),({DIGIT})", "$1" + HELD_COMMA + "$2")


def release_commas(text: Column) -> Column:
    return F.replace(text, F.lit(HELD_COMMA), F.lit(","))


def prepare_list(raw: Column) -> Column:
    """The list-wide steps: one upper-case, comma-separated string."""
    text = drop_water_brackets(strip_heading(collapse_space(raw)))
    return F.trim(F.upper(hold_commas(unify_separators(text))))


def _tidy(text: Column) -> Column:
    return F.trim(_replace(text, " +, *|, +", ","))


def clean_tokens(text: Column) -> Column:
    r"""The per-token steps on a whole comma-separated string: keep what stands before
    the first ``/`` or ``\``; drop ``(...)``; drop `` n%`` after the token's start."""
    text = _replace(text, r" *[/\\][^,]*")
    text = _replace(text, r" *\([^),]*+\)|(\([^),]*+)", "$1")
    return _tidy(_replace(text, rf"(?<=[^, ]) +{DIGIT}+\.?{DIGIT}* *%"))


def apply_synonyms(token: Column, synonyms: Mapping[str, str] = SYNONYMS) -> Column:
    """Exact-match replacement of one token. A dictionary is code, hence small; one
    that is data belongs in a table and a join."""
    renamed = token
    for target in dict.fromkeys(synonyms.values()):
        names = [k for k, v in synonyms.items() if v == target]
        renamed = F.when(token.isin(*names), F.lit(target)).otherwise(renamed)
    return renamed


def is_footnote(token: Column, patterns: Iterable[str] = FOOTNOTES) -> Column:
    """Any pattern fits, in either case. Patterns tied to the start are tried once per
    token; the others only where one of their first letters stands."""
    wide = [unicode_classes(p, BLANK) for p in patterns]
    tied = [f"(?:{p[1:]})" for p in wide if p.startswith("^")]
    free = [f"(?:{p})" for p in wide if not p.startswith("^")]
    found = F.lit(False)
    if tied:
        found = found | token.rlike(r"(?iu)\A(?:" + "|".join(tied) + ")")
    if free:
        firsts = {p[3] for p in free}
        ahead = f"(?=[{''.join(sorted(firsts))}])" if all(f.isalpha() for f in firsts) else ""
        found = found | token.rlike("(?iu)" + ahead + "(?:" + "|".join(free) + ")")
    return found


def is_too_short(token: Column) -> Column:
    return (F.length(token) < MIN_TOKEN_LENGTH) | token.rlike(unicode_classes(COLOUR_INDEX, BLANK))


def split_list(text: Column) -> Column:
    return F.split(text, ",")


def ingredient_array(raw: Column, synonyms: Mapping[str, str] = SYNONYMS) -> Column:
    """Distinct ingredients of a raw list in order of first appearance."""
    tokens = split_list(clean_tokens(prepare_list(raw)))
    real = F.filter(tokens, lambda t: ~is_footnote(t))
    named = F.transform(real, lambda t: apply_synonyms(release_commas(t), synonyms))
    return F.array_distinct(F.filter(named, lambda t: ~is_too_short(t)))
