"""Regular expressions shared by the Spark expressions and the SQL oracles.

Every pattern avoids look-around and back-references so that the JVM
engine and RE2 give equal results.  Han characters are written literally
(U+4E00 to U+9FA5) instead of with escapes, which the two engines spell
differently.
"""

import re

# FIXED VALUES: character classes, delimiter sets and patterns of the data contract.
HAN = "一-龥"
# Latin letters of the test corpus (ASCII plus the Latin-1 letters).
LATIN = "a-zA-Zà-öø-ÿÀ-ÖØ-Þß"

# A character that counts as "text": Han, underscore or ASCII letter.
LETTER_CLASS = f"[{HAN}_a-zA-Z]"
HAN_CLASS = f"[{HAN}]"
# Python's [\a-zA-Z] is the range U+0007..'z' plus A-Z.
WIDE_ASCII_CLASS = "[\\x07-z]"

# Tokens: letter runs, digit runs, any other single non-blank character.
TOKEN_PATTERN = f"[{LATIN}]+|[0-9]+|[^ \\t\\r\\na-zA-Z0-9à-öø-ÿÀ-ÖØ-Þß]"
# Same, but every whitespace character is a token of its own, so that joining
# the tokens with '' gives back the text.
SPACED_TOKEN_PATTERN = f"[{LATIN}]+|[0-9]+|[^a-zA-Z0-9à-öø-ÿÀ-ÖØ-Þß]"


def with_terms(pattern: str, terms) -> str:
    """``pattern`` with the Han words of a lexicon as alternatives before it, the longest first.

    Without them every Han character is a token of its own.
    """
    words = sorted({t for t in terms if len(t) > 1 and re.search(HAN_CLASS, t)}, key=lambda t: (-len(t), t))
    return "|".join([*map(re.escape, words), pattern])


def listed(pattern: str) -> str:
    """``pattern`` with the ranges of letters and digits below U+0100 written out: the same language.

    The JVM engine looks listed characters up in a table, ranges it tries one by one.
    """
    spelt = lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1)))
    return re.sub("([0-9A-Za-zÀ-ÿ])-([0-9A-Za-zÀ-ÿ])", spelt, pattern)


def _members(body: str) -> list[tuple[int, int]]:
    """The ranges of code points in a character class."""
    plain = {"n": "\n", "t": "\t", "r": "\r"}
    chars = [(int(m[1], 16) if m[1] else ord(m[2] and plain.get(m[2], m[2]) or m[0]), m[0] == "-")
             for m in re.finditer(r"\\x([0-9a-fA-F]{2})|\\([^\w]|[ntr])|[^\\]", body, re.S)]
    out, i = [], 0
    while i < len(chars):
        last = i + 2 if i + 2 < len(chars) and chars[i + 1][1] else i
        out.append((chars[i][0], chars[last][0]))
        i = last + 1
    return out


def jvm(pattern: str) -> str:
    """``pattern`` for the JVM engine: each class with its characters below U+0100 as a table that is looked at first; the same language."""
    def spelt(m):
        if m[2] is None or re.fullmatch(r"[^\x00-\xff\\](-[^\\])?", m[2]) and not m[1]:  # an escaped character, or one range
            return m[0]
        ranges, name = _members(m[2]), lambda c: f"\\x{{{c:X}}}"
        low = "".join(name(c) for c in range(256) if any(a <= c <= b for a, b in ranges) != bool(m[1]))
        high = "".join(name(max(a, 256)) + (f"-{name(b)}" if b > max(a, 256) else "") for a, b in ranges if b > 255)
        rest = "[\\x{100}-\\x{10FFFF}" + (f"&&[{m[1]}{high}]" if high else "") + "]" if m[1] or high else ""
        return f"[[{low}]{rest}]" if low else rest
    return re.sub(r"\\.|\[(\^?)((?:\\.|[^\]\\])+)\]", spelt, pattern, flags=re.S)


# Whole-token test for letter tokens.
LETTER_TOKEN = f"^[{LATIN}{HAN}]+$"

# Runs of characters that clean_text replaces with one blank.
CLEAN_RUN = f"[^0-9a-zA-Z{HAN}.，,。？“”;；！!?]+"
# Characters that the clause splitter turns into ';'.
SOFT_BREAKS = "[…_~^$%：～]"
# Sentence-final characters and comma-class characters (previous-token tests).
ENDER_CLASS = "[.。;；！!？?]"
COMMA_CLASS = "[.,，、\\\\ ]"

# Delimiter sets of the clause splitter (by precedence) and the sub-clause splitter.
CLAUSE_DELIMS_ENDERS = ".。！!？?;； "
CLAUSE_DELIMS_COMMAS = ",， "
CLAUSE_DELIMS_BLANK = " "
SUBCLAUSE_DELIMS = ".,，。!？！?、[\\] "

# One run of Latin letters between ASCII characters that are no letters: recomposed, it has no new tokens.
ONE_RUN = f"^[\\x00-@\\[-`{{-\\x7f]*[{LATIN}]+[\\x00-@\\[-`{{-\\x7f]*$"
# Group 1 is the run itself.
THE_RUN = ONE_RUN.replace(f"[{LATIN}]+", f"([{LATIN}]+)").replace("]*", "]*+")

# The single characters that repeat: letter runs and digit runs never stand beside an equal one.
REPEATED = f"([^{LATIN}0-9])\\1+"

# Tokens kept when a clause is recomposed.
RECOMPOSE_KEEP = f"{LETTER_CLASS}|[；，。！,.?？]"

# Blank-only trimming (Python's str.strip on the ASCII whitespace set).
OUTER_BLANKS = "^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$"


def delim_class(chars: str) -> str:
    """A character class matching any of ``chars``, escaped for both engines."""
    out = []
    for ch in chars:
        if ch in "\\[]^-":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "[" + "".join(out) + "]"


def emitted_pattern(chars: str) -> str:
    """The chunks of ``chunk_pattern``; group 1 is empty for one that ends with a delimiter and holds no letter."""
    cls = delim_class(chars)
    neg = "[^" + cls[1:]
    bare = neg[:-1] + LETTER_CLASS[1:]                              # neither a delimiter nor a letter
    return f"({bare}*+{LETTER_CLASS}{neg}*+{cls}?|{neg}++\\z)|{neg}*+{cls}"


def chunk_pattern(chars: str) -> str:
    """Chunks that end with a delimiter, or the trailing rest without one."""
    cls = delim_class(chars)
    neg = "[^" + cls[1:]
    return f"{neg}*{cls}|{neg}+"
