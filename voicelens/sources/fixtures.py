"""Test-corpus dimension tables (taxonomy, word lists, lexicons).

FIXED VALUES — the fixture words of the test corpus.  The original pipeline
reads these from user files; here they are the default dimension rows for the
generated corpus, listed plainly in their line order.
"""

from __future__ import annotations

# FIXED VALUES: taxonomy rows (keyword, code) in line order; the last row
# repeats a keyword and must lose to the first.
TAXONOMY_ROWS = [
    ("thon", "B1"), ("éeau", "B1"),
    ("thth", "B2"), ("ment", "B2"),
    ("thre", "B3"), ("sich", "B3"),
    ("thnt", "B4"), ("elle", "B4"),
    ("thes", "B5"), ("nicht", "B5"),
    ("thha", "B6"), ("eine", "B6"),
    ("thhe", "B7"), ("para", "B7"),
    ("thed", "B8"), ("ción", "B8"),
    ("erin", "B9"), ("mente", "B9"),
    ("thble", "JGP"), ("tion", "JGP"),
    ("anea", "J1"), ("dans", "J1"),
    ("ther", "J2"), ("avec", "J2"),
    ("than", "J3"), ("keit", "J3"),
    ("from", "J4"), ("heit", "J4"),
    ("this", "J6"), ("lich", "J6"),
    ("thon", "B2"),
]

# FIXED VALUES: words of the test corpus playing the airport-context role.
FACILITY_WORDS = ["with"]
# FIXED VALUES: stopwords, stop-keys, polarity and negations of the test corpus.
STOPWORDS = ["the", "and", "of", "la", "le", "de", "que"]
STOPKEYS = ["that", "pour"]
POLARITY = [("that", 1), ("avec", 1), ("para", 1), ("sich", 1),
            ("from", -1), ("dans", -1), ("mente", -1)]
NEGATIONS = ["nicht", "no", "than"]

# The script pattern that marks a keyword worth keeping (Latin letters here;
# the Han range for Chinese text).
KEYWORD_SCRIPT = "[a-zA-Zà-öø-ÿÀ-ÖØ-Þß]"

# FIXED VALUES: mapping of the test corpus for script normalisation (accented → plain letters, and
# phrases that overlap, so that greedy and fewest-units cuts differ); any (from_word, to_word) table can be passed instead.
CHAR_MAP = [("à", "a"), ("â", "a"), ("ç", "c"), ("è", "e"), ("é", "e"), ("ê", "e"),
            ("ó", "o"), ("ö", "o"), ("ü", "u"), ("ß", "s"),
            ("éea", "ea"), ("ée", "E"), ("aux", "o"), ("éeau", "eau"), ("auê", "aw"), ("eé", "ey"), ("éé", "ee"), ("ou", "u")]
